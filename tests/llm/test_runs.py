"""Periodic runs against the definition, word by word."""

import random
import zlib
from hashlib import sha256

import pytest

from fareloom.llm import queries, runs


def brute(words):
    """Runs by the definition: the maximal stretches of every period, smallest period only."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        start = None
        for i in range(q, len(words) + 1):
            if i < len(words) and words[i] == words[i - q]:
                start = i if start is None else start
            elif start is not None:
                s, length = start - q, i - start + q
                part = words[s : s + length]
                smaller = any(part[p:] == part[:-p] for p in range(1, q))
                if length >= max(12, 2 * q) and not smaller:
                    found.append((s, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts():
    dice = random.Random(11)
    for letters in (1, 2, 3, 5, 40):
        for size in (0, 1, 11, 12, 13, 60, 150):
            for _ in range(8):
                yield [b"%d" % dice.randrange(letters) for _ in range(size)]
    for _ in range(250):  # repetitions of repetitions, with faults
        words = [b"%d" % dice.randrange(dice.choice((2, 4, 50))) for _ in range(dice.randint(1, 8))]
        for _ in range(dice.randint(1, 3)):
            words = words * dice.randint(1, 7) + [b"x%d" % dice.randrange(3)] * dice.randint(0, 2)
        words = words[:400]
        for _ in range(dice.randint(0, 3)):
            words[dice.randrange(len(words))] = b"fault"
        yield words


def test_runs_are_those_of_the_definition():
    some = list(texts())
    assert sum(len(brute(words)) for words in some) > 500
    for words in some:
        assert runs.find_runs(words) == brute(words), words


@pytest.mark.parametrize("period", [1, 2, 3, 51])
def test_one_long_run_is_found_in_linear_time(period):
    words = ([b"a"] * (period - 1) + [b"b"]) * (60_000 // period)
    inner = [(at, period - 1, 1) for at in range(0, len(words), period) if period > 12]
    found = sorted([(0, len(words), period), *inner], key=lambda run: (run[0], run[2]))
    assert runs.find_runs(words) == found


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words) if n < 250 else runs.find_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
    shape = (None,) * 4 if best is None else (*best, best[1] * 1000 // best[2])
    return (doc_id, len(found), *shape, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())


def test_query_on_all_documents(spark, sf_dir, rows_of):
    result = queries.all_queries()["op11_runs"](spark, sf_dir)
    assert dict(result.dtypes)["exponent_milli"] == "bigint"
    got = sorted(tuple(row) for row in result.collect())
    known = sorted(rows_of(f"{sf_dir}/documents.parquet", "doc_id, text"))
    assert got == [expected(*row) for row in known]
    assert sum(row[1] > 0 for row in got) > 50


def test_odd_rows(odd, nothing, spark):
    result = runs.run_digests(runs.periodic_runs(runs.repeat_tails(odd)))
    got = [tuple(row) for row in result.collect()]
    assert sorted(got, key=str) == sorted(
        (expected(row["doc_id"], row["text"]) for row in odd.collect()), key=str
    )
    assert runs.run_digests(runs.periodic_runs(runs.repeat_tails(nothing))).collect() == []
    tail = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF20' AS STRING) AS text, 'x' AS runs")
    assert runs.periodic_runs(tail).selectExpr("hex(collapsed)").first()[0] == "61FF"
