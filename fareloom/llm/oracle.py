"""SQL for DuckDB of the text queries that SQL can express."""

from fareloom.llm import licenses as rules

DECONTAMINATE = r"""
WITH docs AS (
    SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL
), doc_words AS (
    SELECT doc_id, text, list_filter(
        string_split_regex(lower(text), '[^\pL\pN]+'), lambda w: w <> '') AS w
    FROM docs
), item_words AS (
    SELECT row_number() OVER () AS item, item_id, list_filter(
        string_split_regex(lower(text), '[^\pL\pN]+'), lambda w: w <> '') AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), items AS (
    SELECT *, least(len(w), 5) AS width FROM item_words WHERE len(w) > 0
), item_shingles AS (
    SELECT DISTINCT item, item_id, width, array_to_string(w[i:i + width - 1], ' ') AS shingle
    FROM items, unnest(range(1, len(w) - width + 2)) AS places(i)
), doc_shingles AS (
    SELECT DISTINCT doc_id, text, width, array_to_string(w[i:i + width - 1], ' ') AS shingle
    FROM doc_words, (SELECT DISTINCT width FROM items), unnest(range(1, len(w) - width + 2)) AS places(i)
), sizes AS (
    SELECT item, count(*) AS n_item FROM item_shingles GROUP BY item
), found AS (
    SELECT doc_id, text, item, item_id, count(*) AS n_found
    FROM doc_shingles JOIN item_shingles USING (width, shingle) GROUP BY doc_id, text, item, item_id
)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM found JOIN sizes USING (item)
WHERE n_found >= n_item * 0.8 - 1e-9
"""


def licenses() -> str:
    """Pieces as rows; a common table expression per sequence, as sequences take from each other."""
    known = ", ".join(f"'{sentence}': '{name}'" for sentence, name in rules.SENTENCES.items())
    text = "translate(replace(text, chr(13) || chr(10), chr(10)), chr(13) || chr(1), chr(10) || ' ')"
    for pattern, put in (
        (rules.LIST_MARK, "chr(1)"),
        (rules.BLANK_LINES, "chr(1)"),
        (rules.LIST_AHEAD, r"chr(1) || '\1'"),
        (rules.SENTENCE_END, r"'\1' || chr(1)"),
        (r"[^A-Za-z0-9\n\x01]+", "' '"),
    ):
        text = f"regexp_replace({text}, '{pattern}', {put}, 'g')"
    steps, names = [], "read"
    for i, (_, rule) in enumerate(rules.SEQUENCES):
        form = rules.sequence(rule)
        rest = f"replace(names, '{form}', ' ')"
        steps.append(
            f"step_{i} AS (SELECT * EXCLUDE (names), {rest} AS names, "
            f"(length(names) - length({rest})) // {len(form) - 1} AS rule_{i} FROM {names})"
        )
        names = f"step_{i}"
    counts = {name: [] for name in rules.LICENCES}
    for i, (name, _) in enumerate(rules.SEQUENCES):
        counts[name].append(f"rule_{i}")
    singles = []
    for name, identifier in rules.SINGLE:
        form = f"<{identifier}>"
        times = f"(length(names) - length(replace(names, '{form}', ''))) // {len(form)}"
        counts[name].append(times)
        singles.append(times)
    left = "length(names) - length(replace(names, '<', ''))"
    counts[rules.FRAGMENT] = [f"{left} - ({' + '.join(singles)})"]
    selects = " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS license, {' + '.join(parts)} AS n_matches FROM {names}"
        for name, parts in counts.items()
    )
    return f"""
WITH known AS (
    SELECT MAP {{{known}}} AS known
), cut AS (
    SELECT row_number() OVER () AS document, doc_id, string_split(lower({text}), chr(1)) AS pieces
    FROM documents WHERE text IS NOT NULL
), piece AS (
    SELECT document, doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM cut
), lines AS (
    SELECT * EXCLUDE (piece), list_filter(list_transform(
        string_split(piece, chr(10)), lambda s: trim(s)), lambda s: s <> '') AS lines FROM piece
), ends AS (
    SELECT *, list_transform(
        range(1, len(lines) + 1), lambda i: array_to_string(lines[i:], ' ')) AS ends
    FROM lines WHERE len(lines) > 0
), first AS (
    SELECT * EXCLUDE (known), list_position(
        list_transform(ends, lambda s: known[s] IS NOT NULL), TRUE) AS first,
        list_transform(lines, lambda s: known[s]) AS line_names,
        list_transform(ends, lambda s: known[s]) AS end_names
    FROM ends, known
), found AS (
    SELECT document, doc_id, place, list_filter(
        CASE WHEN first > 0 THEN list_append(line_names[1:first - 1], end_names[first])
             ELSE line_names END, lambda n: n IS NOT NULL) AS names
    FROM first
), read AS (
    SELECT document, doc_id, string_agg(
        array_to_string(list_transform(names, lambda n: '<' || n || '>'), ''), '' ORDER BY place) AS names
    FROM found WHERE len(names) > 0 GROUP BY document, doc_id
), {", ".join(steps)}
SELECT doc_id, license, CAST(n_matches AS BIGINT) AS n_matches FROM ({selects}) WHERE n_matches > 0"""


ORACLES = {"op3_decontaminate": DECONTAMINATE, "op8_licenses": licenses()}
