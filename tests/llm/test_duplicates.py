"""Fingerprints, links and components against brute force."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import edit, queries, simhash
from fareloom.llm.components import components


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def check_groups(rows, texts_by_row):
    prints = [plain_fingerprint(text or "") for _, text in texts_by_row]
    linked = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    root = groups(len(prints), linked)
    least = {}
    for (doc_id, _), r in zip(texts_by_row, root, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    expected = Counter(
        (doc_id, f"{p:016x}", least.get(r))
        for (doc_id, _), p, r in zip(texts_by_row, prints, root, strict=True)
    )
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == expected


def test_simhash_query_is_brute_force(spark, sf_dir, rows_of):
    rows = queries.all_queries()["op4_simhash"](spark, sf_dir).collect()
    check_groups(rows, rows_of(f"{sf_dir}/documents.parquet", "doc_id, text"))


def test_simhash_of_odd_rows(odd, nothing):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_groups(simhash.near_groups(odd).collect(), texts)
    assert simhash.near_groups(nothing).collect() == []


@pytest.mark.parametrize("hot_key", [0, 3, simhash.HOT_KEY])
def test_every_link_is_found_once(spark, hot_key):
    random.seed(hot_key)
    centres = [random.getrandbits(64) for _ in range(6)]
    values = set(centres)
    for _ in range(300):
        value = random.choice(centres)
        for _ in range(random.randint(1, 4)):
            value ^= 1 << random.randrange(64)
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    got = [(r["u"], r["v"]) for r in simhash.links(frame, hot_key).collect()]
    mask = (1 << 64) - 1
    expected = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2
    }
    assert len(expected) > 50
    assert {tuple(sorted(pair)) for pair in got} == expected
    assert len(got) == len(expected)


def test_components_of_chains_stars_and_circles(spark):
    random.seed(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    pairs += [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(7, 7), (5, 4), (4, 5)]
    random.shuffle(pairs)
    frame = spark.createDataFrame(pairs, "u bigint, v bigint")
    got = {(r["u"], r["v"]) for r in components(frame).collect()}
    nodes = sorted({x for pair in pairs for x in pair})
    at = {x: i for i, x in enumerate(nodes)}
    root = groups(len(nodes), [(at[a], at[b]) for a, b in pairs])
    members = defaultdict(list)
    for x in nodes:
        members[root[at[x]]].append(x)
    assert got == {(x, min(m)) for m in members.values() for x in m if x != min(m)}
    assert components(frame.where("u < 0")).collect() == []


def check_neighbours(rows, texts):
    """Rows against fingerprints and texts worked out one by one."""
    embed = edit.embedding()
    hashed = {t: np.uint64(xxhash.xxh64_intdigest(t or "", 42)).view(np.int64) for _, t in texts}
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]]))
    expected = Counter()
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (embed.fingerprint(x) for x in (text, edited, after))
        expected[
            doc_id, len(text), sha256(edited.encode()).hexdigest(), a.hex(), b.hex(),
            edit.likeness(a, b), edit.likeness(a, c),
        ] += 1
    columns = (
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    )
    assert Counter(tuple(r[c] for c in columns) for r in rows) == expected


def test_edit_query_is_brute_force(spark, small_dir, rows_of):
    rows = queries.all_queries()["op6_edit_fingerprints"](spark, small_dir).collect()
    check_neighbours(rows, rows_of(f"{small_dir}/documents.parquet", "doc_id, text"))


def test_edit_of_odd_rows(odd, nothing):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_neighbours(edit.compare_neighbours(odd).collect(), texts)
    one = odd.where("doc_id = 3 AND text = 'one'")
    check_neighbours(edit.compare_neighbours(one).collect(), [(3, "one")])
    assert edit.compare_neighbours(nothing).collect() == []


def test_walk_is_the_definition():
    """The automaton against a walk bit by bit."""
    embed = edit.embedding()
    going = np.random.default_rng(edit._SEED).integers(
        0, 2, (2 * edit.PERIOD, edit.LETTERS), dtype=np.int8
    )[: edit.PERIOD]
    letters = bytes(random.Random(2).randrange(256) for _ in range(3000))
    place, ends = 0, []
    for letter in letters:
        while not going[place % edit.PERIOD, letter]:
            place += 1
        place += 1
        ends.append(place)
    assert embed.walk(letters).tolist() == ends
    assert embed.walk(letters[1000:], ends[999]).tolist() == ends[1000:]


def test_few_edits_are_alike_and_other_texts_are_not():
    rng, embed = random.Random(3), edit.embedding()
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "house", "river", "tree", "stone"]
    alike, apart = [], []
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(300))
        at = rng.randrange(len(text))
        alike.append(edit.likeness(embed.fingerprint(text), embed.fingerprint(text[:at] + text[at + 1 :])))
        other = " ".join(rng.choice(words) for _ in range(300))
        apart.append(edit.likeness(embed.fingerprint(text), embed.fingerprint(other)))
    assert np.median(alike) > 0.9 and np.mean(np.array(alike) >= 0.8) > 0.8
    assert np.max(apart) < 0.5


def test_near_pairs_are_those_of_all_comparisons(spark):
    rng = random.Random(4)
    texts = []
    for i in range(40):
        text = " ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(200))
        texts += [text, text, text[:500] + "x" + text[500:], text[: 100 * (i % 6)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (900, None), (901, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    without = " ".join(rng.choice("qr st uv wx yz".split()) for _ in range(300))
    rows += [(None, without)] * 2
    rows += [(None, without[:at] + "y" + without[at:]) for at in range(100, 900, 50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash"))
    got = {
        (r["u"], r["v"]): (r["u_id"], r["v_id"], r["likeness"])
        for r in edit.near_pairs(frame).collect()
    }
    embed, first = edit.embedding(), {}
    for doc_id, text in rows:
        print_ = embed.fingerprint(text or "")
        known = [x for x in (first.get(print_), doc_id) if x is not None]
        first[print_] = min(known, default=None)
    expected = {}
    for a, i in first.items():
        for b, j in first.items():
            if a < b and edit.likeness(a, b) >= edit.LIKE:
                expected[a.hex(), b.hex()] = (i, j, edit.likeness(a, b))
    assert expected and got == expected
    assert any(i is None and j is None for i, j, _ in expected.values())
    assert edit.near_pairs(frame.where(F.lit(False))).collect() == []


def test_what_nearly_all_have_in_common_makes_no_pairs(spark):
    """Bands that all fingerprints share are left out, and no link is lost."""
    rng = random.Random(9)
    common = [rng.randbytes(24) for _ in range(2)]
    prints = [common[i % 2] + rng.randbytes(104) for i in range(300)]
    for p in list(prints[:60]):
        changed = bytearray(p)
        for at in rng.sample(range(128), rng.randint(1, 30)):
            changed[at] ^= 1
        prints.append(bytes(changed))
    classes = spark.createDataFrame([(bytearray(p),) for p in prints], "fp binary")
    bands = edit._rare_bands(classes, edit.LIKE).collect()
    holders = defaultdict(list)
    for row in bands:
        holders[row["band"]].append(bytes(row["fp"]))
    met = {tuple(sorted(pair)) for some in holders.values() for pair in combinations(some, 2)}
    near = {
        tuple(sorted((a, b))) for a, b in combinations(prints, 2) if edit.likeness(a, b) >= edit.LIKE
    }
    assert near and near <= met and len(met) < 200
