"""The native operators and their SQL on rows that the given tables do not have."""

import random

import duckdb
import pyarrow as pa
from compare import compare
from test_licence_texts import AS_IS, BSD, GPL, GRANT, HEAD, ISC, ITEMS, NOTICE, listed, wrap

from fareloom.llm import decontaminate, licenses
from fareloom.llm.oracle import ORACLES

MIT = wrap("The MIT License (MIT)", HEAD.strip(), GRANT, NOTICE, AS_IS)
TEXTS = {
    MIT: {"MIT": 1},
    f"{MIT}\n\nReleased under the MIT License\nand so it goes on": {"MIT": 2},
    f"MIT License\n{HEAD.strip()}\n{wrap(GRANT, NOTICE)}": {"MIT": 2},
    listed("{}. "): {"BSD-3-Clause": 1},
    listed("({}) ", between="\n"): {"BSD-3-Clause": 1},
    wrap(HEAD, ISC): {"ISC": 1},
    wrap(HEAD, GPL): {"GPL-3.0-or-later": 1},
    "\r\n".join(f" * {line}" for line in MIT.split("\n")): {"MIT": 1},
    "License: MIT": {"MIT": 1},
    "SPDX-License-Identifier: LGPL-3.0-or-later\nx": {"LGPL-3.0-or-later": 1},
    "# SPDX-License-Identifier: AGPL-3.0-only": {"AGPL-3.0": 1},
    "// SPDX-License-Identifier: Unlicense": {"Unlicense": 1},
    "                Apache License\n          Version 2.0, January 2004\n"
    "       http://www.apache.org/licenses/\n\n  TERMS": {"Apache-2.0": 1},
    "   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Copyright": {"GPL-3.0": 1},
    "Licensed under the GNU Affero General Public License,\nversion 3.\nMore": {"AGPL-3.0": 1},
    wrap(NOTICE): {licenses.FRAGMENT: 1},
    f"{GRANT}\n\nAll rights reserved.": {licenses.FRAGMENT: 1, "Proprietary": 1},
    "A mit licence is no licence": {},
    "\n\n \x01 \r\r\n": {},
    "": {},
    "All rights\nreserved.\nAll rights reserved! ünïcödé All rights reserved": {"Proprietary": 2},
}


def database(**tables):
    db = duckdb.connect()
    for name, (columns, rows) in tables.items():
        kinds = [("BIGINT" if c.endswith("_id") else "VARCHAR") for c in columns]
        fields = ", ".join(f"{c} {k}" for c, k in zip(columns, kinds, strict=True))
        db.execute(f"CREATE TABLE {name} ({fields})")
        arrays = [pa.array(c, pa.int64() if k == "BIGINT" else pa.string()) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        given = pa.table(arrays, names=list(columns))  # noqa: F841
        db.execute(f"INSERT INTO {name} SELECT * FROM given")
    return db


def test_licence_texts(spark):
    rows = list(enumerate(TEXTS))
    found = {i: {} for i, _ in rows}
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for row in licenses.scan(frame).collect():
        found[row["doc_id"]][row["license"]] = row["n_matches"]
    assert found == {i: TEXTS[text] for i, text in rows}


def test_licences_in_both(spark):
    dice = random.Random(3)
    known = [*TEXTS, *licenses.SENTENCES, *ITEMS, BSD]
    rows = [(i, text) for i, text in enumerate(known)] + [(None, None), (1, MIT), (None, MIT)]
    for i in range(400):
        parts = [dice.choice(known) for _ in range(dice.randint(1, 4))]
        text = dice.choice(["\n", "\n\n", " ", ". ", ".\n", ":\n", "\r\n"]).join(parts)
        if dice.random() < 0.3:
            at = dice.randrange(len(text) + 1)
            text = text[:at] + dice.choice(["\n", "!", " x ", "(1) ", "\n- "]) + text[at:]
        rows.append((i, text))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    db = database(documents=(("doc_id", "text"), rows))
    assert licenses.scan(frame).count() > 700
    assert compare(licenses.scan(frame), db, ORACLES["op8_licenses"]) == []


def test_every_licence_has_a_sentence():
    assert set(licenses.LICENCES) >= set(licenses.NAMES)
    named = {name for _, rule in licenses.SEQUENCES for name in rule} | {i for _, i in licenses.SINGLE}
    assert set(licenses.SENTENCES.values()) == named


def test_passages_in_both(spark):
    """Short items, items without an id, texts that share an id, repeated rows."""
    dice = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [
        (dice.choice([None, 1, 2, 3]), " ".join(dice.choices(words, k=dice.choice([1, 2, 4, 5, 9, 30]))))
        for _ in range(40)
    ]
    items += items[:5] + [(7, None), (8, " ! "), (None, "no such passage in any document")]
    docs = [(None, None), (1, ""), (2, "w1 W2!")]
    for i in range(120):
        text = " ".join(dice.choices(words, k=dice.choice([2, 30, 300])))
        docs.append((dice.choice([i, None, 5]), f"{text} {dice.choice(items[:40])[1]}"))
    docs += docs[-6:]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contained_items(frame, bench).drop("text_hash")
    assert found.where("item_id IS NULL").count() > 20
    db = database(documents=(("doc_id", "text"), docs), benchmark=(("item_id", "text"), items))
    assert compare(found, db, ORACLES["op3_decontaminate"]) == []
