"""License scans by sentence rules.

A text is cut at the ends of sentences (`.`, `!`, `?` before white space), at
blank lines, at marks of a list like `(1)` and at a colon before a list. Licence
texts are wrapped, so a piece between cuts is read as a whole, line breaks taken
for spaces, and so is any end of it that starts at a line: a title or a copyright
line may stand before a sentence. The longest one that is a known sentence counts,
and lines before it that are known sentences by themselves; if there is none, all
lines that are. So every place of a text is read once.

A sentence is normalised (letters A-Z and digits in lower case, anything else one
space) and looked up among known licence sentences. The identifiers found, in the
order of the text, are matched against rules, sequences of identifiers, one rule
after the other; what a rule has matched is not matched again. Identifiers that no
rule takes are reported as a fragment.

The result has one row per document row and licence, with the number of its
matches. Texts without a licence, empty texts, nulls and empty tables have no
row; texts of any length are read whole; repeated rows have a row each; ids may
be null; extra columns are left out. All of it is DataFrame expressions over one
row at a time, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAGMENT = "licence-fragment"

# Licences with the names that texts refer to them by, besides their
# SPDX identifier.
NAMES = {
    "MIT": ("mit license", "the mit license", "mit licence"),
    "Apache-2.0": (
        "apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 license",
        "apache license version 2 0 the license",
    ),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v 2 0"),
    "GPL-3.0": ("gnu general public license version 3", "gnu general public license v3 0", "gnu gpl version 3", "gnu gpl v3", "gplv3"),
    "GPL-2.0": ("gnu general public license version 2", "gnu general public license v2 0", "gnu gpl version 2", "gnu gpl v2", "gplv2"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lgpl version 3", "lgplv3"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "gnu lgpl version 2 1"),
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu agpl version 3", "agplv3"),
    "GPL-3.0-or-later": ("gnu general public license version 3 or later",),
    "GPL-2.0-or-later": ("gnu general public license version 2 or later",),
    "LGPL-3.0-or-later": ("gnu lesser general public license version 3 or later",),
    "LGPL-2.1-or-later": ("gnu lesser general public license version 2 1 or later",),
    "AGPL-3.0-or-later": ("gnu affero general public license version 3 or later",),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"),
    "CC0-1.0": ("cc0 1 0", "creative commons zero v1 0 universal"),
    "Unlicense": ("unlicense",),
}

# How a text says by name what it is licensed under.
BY_IDENTIFIER = ("spdx license identifier {}", "license {}", "licence {}")
BY_NAME = (
    "licensed under {}", "licensed under the {}", "licensed under a {}", "released under the {}",
    "distributed under the {}", "license {}", "this project is licensed under the {}",
    "this work is licensed under the {}", "this work is licensed under a {}",
    "this software is licensed under the {}", "this work is dedicated to the public domain under {}",
)

# Title lines of licence texts.
TITLES = {
    "MIT": ("mit license", "the mit license", "the mit license mit"),
    "Apache-2.0": (
        "apache license version 2 0 january 2004",
        "apache license version 2 0 january 2004 http www apache org licenses",
    ),
    "BSD-3-Clause": ("bsd 3 clause license", "the 3 clause bsd license"),
    "BSD-2-Clause": ("bsd 2 clause license", "the 2 clause bsd license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2 0",),
    "GPL-3.0": ("gnu general public license version 3 29 june 2007",),
    "GPL-2.0": ("gnu general public license version 2 june 1991",),
    "LGPL-3.0": ("gnu lesser general public license version 3 29 june 2007",),
    "LGPL-2.1": ("gnu lesser general public license version 2 1 february 1999",),
    "AGPL-3.0": ("gnu affero general public license version 3 19 november 2007",),
    "CC-BY-4.0": ("attribution 4 0 international", "creative commons attribution 4 0 international public license"),
    "CC0-1.0": ("cc0 1 0 universal",),
}

# Normalised sentences of public licence texts and notices, with
# the identifier of each. Several sentences may say the same.
TEXTS = {
    "all rights reserved": "all-rights",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-comply",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL-2.0",
    "this is free and unencumbered software released into the public domain": "Unlicense",
}

# Fixed value: the notice of the GNU licences, with the family's name and version.
GNU_NOTICE = (
    "this {} is free software you can redistribute it and or modify it under the terms of the gnu "
    "{} as published by the free software foundation either version {} of the license or at your "
    "option any later version"
)
GNU = {
    "GPL-3.0-or-later": ("general public license", "3"),
    "GPL-2.0-or-later": ("general public license", "2"),
    "LGPL-3.0-or-later": ("lesser general public license", "3"),
    "LGPL-2.1-or-later": ("lesser general public license", "2 1"),
    "AGPL-3.0-or-later": ("affero general public license", "3"),
}


def _normal(name: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in name.lower()).split())


def _sentences() -> dict[str, str]:
    """All known sentences with their identifiers; a licence's name is that of a reference."""
    found = {
        form.format(name): licence
        for licence, names in NAMES.items()
        for forms, known in ((BY_NAME, names), (BY_IDENTIFIER, (_normal(licence),)))
        for form in forms
        for name in known
    }
    for licence in NAMES:  # a version alone, and its older spelling
        if licence.endswith("L-3.0") or licence == "GPL-2.0":
            found[f"spdx license identifier {_normal(licence)} only"] = licence
    for licence, (family, version) in GNU.items():
        for thing in ("program", "library", "software"):
            found[GNU_NOTICE.format(thing, family, version)] = licence
    titles = {title: f"{licence}-title" for licence, known in TITLES.items() for title in known}
    return found | titles | TEXTS


SENTENCES = _sentences()

# A licence and the identifiers that its text consists of, the longest first.
SEQUENCES = (
    ("Apache-2.0", ("Apache-2.0", "apache-comply", "apache-see")),
    ("Apache-2.0", ("Apache-2.0", "apache-comply")),
    ("MIT", ("MIT-title", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("BSD-3-Clause-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("BSD-2-Clause-title", "bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("ISC-title", "isc-grant")),
)
SINGLE = (
    ("ISC", "isc-grant"), ("Proprietary", "all-rights"),
    *((licence, f"{licence}-title") for licence in TITLES),
    *((licence, licence) for licence in NAMES),
)
LICENCES = tuple(dict.fromkeys(name for name, _ in (*SEQUENCES, *SINGLE)))

# Where a text is cut besides the ends of sentences; the same for Spark and its SQL twin.
LIST_MARK = r":?[ \t]*\n[ \t*/#;-]*\(?[0-9a-zA-Z]{1,2}\)[ \t]+"
BLANK_LINES = r"\n([ \t*/#;-]*\n)+"
LIST_AHEAD = r":[ \t]*\n([ \t*/#;-]*\(?[0-9a-zA-Z]{1,2}[.)][ \t]|[ \t]*[-*\x{2022}][ \t]+[A-Z])"
SENTENCE_END = r"([.!?])[ \t\n]+"
CUT = "\x01"


def sequence(rule: tuple[str, ...]) -> str:
    return "".join(f"<{name}>" for name in rule)


def pieces(text: Column) -> Column:
    """The normalised pieces of a text between cuts, with their line breaks."""
    lines = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), f"\r{CUT}", "\n ")
    lines = F.regexp_replace(lines, LIST_MARK, CUT)
    lines = F.regexp_replace(lines, BLANK_LINES, CUT)
    lines = F.regexp_replace(lines, LIST_AHEAD, f"{CUT}$1")
    cut = F.regexp_replace(lines, SENTENCE_END, f"$1{CUT}")
    return F.split(F.lower(F.regexp_replace(cut, f"[^A-Za-z0-9\n{CUT}]+", " ")), CUT)


def _list(texts) -> str:
    return ", ".join(f"'{text}'" for text in texts)


def identifiers(found: str) -> Column:
    """The known sentences of a text, given its pieces, as one string of identifiers.

    Arrays of one element name what is used more than once: the lines of a piece,
    its ends from each line on, and the first known one among these.
    """
    known = f"s -> s IN ({_list(SENTENCES)})"
    names = _list(x for pair in SENTENCES.items() for x in pair)
    shortest = min(map(len, SENTENCES))
    of_lines = f"""
        flatten(transform(array(filter(transform(split(p, '\\n'), s -> trim(s)), s -> s <> '')), l ->
        flatten(transform(array(transform(
            sequence(1, greatest(size(l), 1)), i -> array_join(slice(l, i, size(l)), ' '))), e ->
        flatten(transform(array(CAST(array_position(transform(e, {known}), true) AS INT)), f ->
            IF(f > 0,
               concat(filter(slice(l, 1, greatest(f - 1, 0)), {known}), array(element_at(e, f))),
               filter(l, {known}))))))))"""
    sentences = f"""
        flatten(transform(filter({found}, p -> length(p) >= {shortest}), p ->
            IF(instr(p, '\\n') = 0, filter(array(trim(p)), {known}), {of_lines})))"""
    return F.expr(
        f"array_join(transform({sentences}, s -> concat('<', try_element_at(map({names}), s), '>')), '')"
    )


def _times(names: str, form: str) -> Column:
    """How often a sequence stands in a string of identifiers."""
    rest = F.replace(F.col(names), F.lit(form), F.lit(""))
    return ((F.length(names) - F.length(rest)) / len(form)).cast("bigint")


def scan(docs: DataFrame) -> DataFrame:
    """Licences per document: `doc_id`, `license` and `n_matches`."""
    read = docs.select("doc_id", pieces(F.col("text")).alias("pieces"))
    read = read.select("doc_id", identifiers("pieces").alias("names")).where("names <> ''")
    # A boundary for the optimiser: rules refer to the identifiers many times.
    read = read.select("doc_id", F.explode(F.array("names")).alias("names"))
    for i, (_, rule) in enumerate(SEQUENCES):
        form = sequence(rule)
        left = F.replace(F.col("names"), F.lit(form), F.lit(" "))
        shrunk = (F.length("names") - F.length(left)) / (len(form) - 1)
        read = read.withColumns({f"rule_{i}": shrunk.cast("bigint"), "left": left})
        read = read.drop("names").withColumnRenamed("left", "names")
    rules = [f"rule_{i}" for i in range(len(SEQUENCES))]
    read = read.select("doc_id", *rules, F.explode(F.array("names")).alias("names"))
    counts = {name: F.lit(0).cast("bigint") for name in LICENCES}
    for i, (name, _) in enumerate(SEQUENCES):
        counts[name] = counts[name] + F.col(f"rule_{i}")
    for name, identifier in SINGLE:
        counts[name] = counts[name] + _times("names", sequence((identifier,)))
    alone = _list(identifier for _, identifier in SINGLE)
    counts[FRAGMENT] = F.size(
        F.expr(f"filter(regexp_extract_all(names, '<([^>]+)>', 1), n -> n NOT IN ({alone}))")
    ).cast("bigint")
    structs = [F.struct(F.lit(name).alias("license"), n.alias("n_matches")) for name, n in counts.items()]
    return read.select("doc_id", F.inline(F.array(*structs))).where("n_matches > 0")
