"""Chat formatting, benchmark passages and licences."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from compare import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareloom.llm import chat, decontaminate, licenses, queries
from fareloom.llm.oracle import ORACLES

PIECES = [*chat._ALL, "\\", "[", "<", "/INST]", " ", "\n", "a", "[\\/INST]", "<\\\\/s>", "é"]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["user", "assistant", "system", "tool", "", "a\nb", "x\\n", "[INST]"]),
            st.lists(st.sampled_from(PIECES), max_size=8).map("".join),
        ),
        max_size=6,
    )
)
def test_any_conversation_survives(turns):
    made = [chat.format_turn(*turn) for turn in turns]
    assert [t[:2] for t in chat.parse("".join(m[0] for m in made))] == turns
    for (_, text), (formatted, start, end) in zip(turns, made, strict=True):
        assert chat.unescape(formatted[start:end]) == text


def test_plain_texts_stay_as_they_are():
    assert chat.format_turn("user", "hello [there] <s")[0] == "[INST] hello [there] <s [/INST]"
    assert chat.format_turn("assistant", chat._EXAMPLE)[0] == "[OUT] <\\/s>[\\INST] ok [\\/INST] </s>"
    with pytest.raises(chat.ParseError):
        chat.parse("[INST] a [INST] b [/INST]")


def expected_conversations(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is None, turn or 0, role or "", text or "", role is not None))
    result = {}
    for conv_id, found in turns.items():
        found.sort()
        every = "".join(f"{role}\n{text}\n" for _, _, role, text, _ in found)
        learnt = "".join(text for _, _, role, text, _ in found if role == "assistant")
        result[conv_id] = (
            len(found), sha256(every.encode()).hexdigest(), len(learnt),
            sha256(learnt.encode()).hexdigest(),
        )
    return result


def check_conversations(frame, rows):
    got = {
        r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
        for r in frame.collect()
    }
    assert got == expected_conversations(rows)


def test_chat_query_is_brute_force(spark, sf_dir, rows_of):
    rows = rows_of(f"{sf_dir}/conversations.parquet", "conv_id, turn, role, text")
    rows += [(-1, 0, "user", chat._EXAMPLE), (-1, 1, "assistant", chat._EXAMPLE)]
    frame = queries.all_queries()["op5_chat"](spark, sf_dir)
    check_conversations(frame, rows)
    assert frame.where("formatted_chars <= loss_chars").count() == 0


def test_chat_of_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "x </s> y"),
        (1, 1, "assistant", "x </s> y"), (1, None, None, "late"), (None, 2, "tool", "a\nb"),
        (None, 1, "assistant", "z" * 200_000), (2, 0, "weird\nrole\\n", "[/INST]"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumns({"formatted": F.lit("clash"), "source": F.lit("clash")})
    check_conversations(chat.read_back(chat.format_conversations(frame)), rows)
    assert chat.read_back(chat.format_conversations(frame.where(F.lit(False)))).collect() == []


def test_the_loss_mask_covers_assistant_texts(spark):
    rows = [(1, 0, "user", "[OUT] a </s>"), (1, 1, "assistant", "b [\\/INST] </s> é"), (1, 2, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = sorted(tuple(r) for r in chat.format_conversations(frame).drop("conv_id").collect())
    under = [chat.unescape(f[start:end]) for _, _, _, f, start, end in made]
    assert under == ["", rows[1][3], ""]
    moved = chat.format_conversations(frame).withColumn("loss_end", F.greatest(F.col("loss_end") - 1, F.lit(0)))
    digest = sha256(chat.unescape(made[1][3][made[1][4] : made[1][5] - 1]).encode()).hexdigest()
    assert chat.read_back(moved.where("turn < 2")).first()["loss_sha256"] == digest


def test_bytes_that_are_no_text(spark):
    text = "CAST(X'61FF62' AS STRING)"
    frame = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'assistant' AS role, {text} AS text")
    row = chat.read_back(chat.format_conversations(frame)).first()
    assert row["loss_sha256"] == sha256("a\ufffdb".encode()).hexdigest()


def test_conversation_of_many_turns(spark):
    n = 20_000
    frame = spark.range(n).selectExpr(
        "7 AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "concat('turn ', id, ' [INST]') AS text",
    )
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(n)]
    check_conversations(chat.read_back(chat.format_conversations(frame)), rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    frame = queries.all_queries()[name](spark, sf_dir)
    assert compare(frame, connect(sf_dir), ORACLES[name]) == []


def plain_words(text):
    kept = "".join(c if c.isalpha() or c.isdecimal() else " " for c in text.lower())
    return kept.split()


def plain_shingles(text, size):
    words = plain_words(text)
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_partly_contained_and_short_items(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(60)]
    items += [(90, None), (91, " !? "), (92, "W1, w2.")]
    docs = [(0, None), (1, ""), (2, "w1 W2!"), (None, items[30][1])]
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 3000]))]
        item = plain_words(rng.choice(items[:60])[1])
        for _ in range(rng.randint(0, 3)):
            if item:
                item[rng.randrange(len(item))] = "changed"
        at = rng.randrange(len(words))
        docs.append((i + 10, " ".join(words[:at] + item + words[at:])))
    docs += docs[-3:]
    expected = set()
    for item_id, text in items:
        size = min(5, len(plain_words(text or "")))
        own = plain_shingles(text or "", size) if size else set()
        for doc_id, doc in docs:
            found = len(own & plain_shingles(doc or "", size)) if own else 0
            if own and found >= 0.8 * len(own) - 1e-9:
                expected.add((doc_id, item_id, len(own), found))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    frame = frame.withColumns({n: F.lit(1) for n in ("w", "h", "q", "item_id", "places", "f", "k")})
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    bench = bench.withColumns({n: F.lit(1) for n in ("doc_id", "w", "h", "width")})
    got = decontaminate.contained_items(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_found"]) for r in got} == expected
    assert 20 < len(expected)
    assert decontaminate.contained_items(frame, bench.where(F.lit(False))).collect() == []
    assert decontaminate.contained_items(frame.where(F.lit(False)), bench).collect() == []


def test_passages_in_odd_rows(odd, spark):
    bench = spark.createDataFrame([(1, "word word word word word word")], "item_id bigint, text string")
    rows = decontaminate.contained_items(odd, bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(10, 1)]


MIT = next(s for s, name in licenses.SENTENCES.items() if name == "mit-grant")
NOTICE = next(s for s, name in licenses.SENTENCES.items() if name == "mit-notice")
WARRANTY = next(s for s, name in licenses.SENTENCES.items() if name == "mit-warranty")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Words.\nReleased under the MIT License\nmore words", {"MIT": 1}),
        ("Intro! Licensed under CC BY-NC 4.0. And on.", {"CC-BY-NC-4.0": 1}),
        ("Licensed under the Apache License,\nVersion 2.0.\nText", {"Apache-2.0": 1}),
        (f"MIT License.\n{MIT}.\n{NOTICE}.\n{WARRANTY}.", {"MIT": 1}),
        (f"{MIT}. {WARRANTY}.", {licenses.FRAGMENT: 2}),
        ("Released under the MIT License. " * 3, {"MIT": 3}),
        ("SPDX-License-Identifier: MIT\nAll rights reserved.", {"MIT": 1, "Proprietary": 1}),
        ("We talk about the MIT License, released under it.", {}),
    ],
)
def test_licence_rules(spark, text, expected):
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert {r["license"]: r["n_matches"] for r in licenses.scan(frame).collect()} == expected


def test_licences_of_odd_rows(odd, nothing, spark):
    assert licenses.scan(odd).collect() == []
    assert licenses.scan(nothing).collect() == []
    rows = [(None, "Released under the MIT License.")] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lines", F.lit(1))
    assert len(licenses.scan(frame.withColumn("license", F.lit("x"))).collect()) == 2
