"""Periodic runs of words, by an online sparse dynamic programme over lags.

A run is a stretch of consecutive words with smallest period q, of at least 12
words and two periods, that no neighbouring word extends. On the diagonal of lag
q it is a row of words, each equal to the word q before it. Every run has six
such words in a row at least, so a word counts together with the five before it
(a gram): words are read one by one, the earlier places of the same gram
increment the match lengths of their lags, and a lag that the word does not
continue ends there; if it is long enough, its run is emitted at once.

Only lags that match now are kept. Inside a run of three periods p or more, lags
of two periods and up that lie wholly inside need not be followed: multiples of
p never have q as smallest period and end with the run, and the others match as
the lag reduced by whole periods does, and never for a whole period. They are
looked up by these rules when the run ends. So a text that is one run takes
constant work a word. Work is otherwise the number of places with equal grams;
memory is linear in one text.

Words are runs without ASCII white space. A null text has no words. Rows stand
for themselves, so ids may be null or repeat, equal texts have equal runs, and
extra columns are left out. Texts of any length are read whole; an empty table
gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches

LEAST = 12  # words in a run
GRAM = 6  # words in a row that any run has matched at its lag
_WORD = r"[^\x20\x09-\x0D]+"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Run = tuple[int, int, int]  # start, length, period


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(word, len(known)) for word in words], np.uint64)


def _may_repeat(numbers: np.ndarray) -> bool:
    """Whether a gram can occur twice; a few false alarms do no harm."""
    n = len(numbers) - GRAM + 1
    key = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM):
        key = key * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + n]
    key.sort()
    return bool((key[1:] == key[:-1]).any())


def _grams(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams by where they start, and how often each name occurs."""

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = (a[: len(b)] << np.uint64(32)) | b
        return np.unique(both, return_inverse=True)[1].astype(np.uint64)

    two = paired(numbers, numbers[1:])
    four = paired(two, two[2:])
    six = paired(four, two[4:]).astype(np.int64)
    return six, np.bincount(six)


def _prime_factors(n: int) -> set[int]:
    found, factor = set(), 2
    while factor * factor <= n:
        while n % factor == 0:
            found.add(factor)
            n //= factor
        factor += 1
    return found | ({n} if n > 1 else set())


class _Diagonals:
    """The lags that match at the place read last, and the runs that ended."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.farthest = len(numbers) // 2  # a run has two periods
        self.at = -1
        self.active: dict[int, int] = {}  # lag: grams in a row
        self.inside: list[tuple[int, int]] = []  # period and start of long runs, by period
        self.runs: list[Run] = []

    def _skipped(self, lag: int, at: int, inside: list[tuple[int, int]]):
        """The run that spares following a lag at a place, if any."""
        for period, start in inside:
            if lag >= 2 * period and at - lag >= start + period + GRAM - 1:
                return period, start
        return None

    def _matched(self, lag: int) -> int:
        """Grams in a row at a lag up to the place read last, followed or not."""
        while lag not in self.active:
            run = self._skipped(lag, self.at, self.inside)
            if run is None:
                return 0
            period, start = run
            if lag % period == 0:
                return self.at - lag - start - GRAM + 2
            lag = period + lag % period
        return self.active[lag]

    def _end(self, lag: int, grams: int) -> None:
        words = grams + GRAM - 1
        if words < max(LEAST - lag, lag):
            return
        start, end = self.at - words - lag + 1, self.at + 1
        stretch = self.numbers[start:end]
        for factor in _prime_factors(lag):
            period = lag // factor
            if np.array_equal(stretch[period:], stretch[:-period]):
                return
        self.runs.append((start, end - start, lag))

    def end_all(self) -> None:
        for lag, grams in self.active.items():
            self._end(lag, grams)
        self.active, self.inside = {}, []

    def read(self, at: int, earlier: list[int]) -> None:
        """The gram that ends at a place, and where it ended before (in order)."""
        if at != self.at + 1:
            self.end_all()
            self.at = at - 1
        now, inside, k = {}, [], len(earlier) - 1
        while k >= 0 and at - earlier[k] <= self.farthest:
            lag = at - earlier[k]
            run = self._skipped(lag, at, inside) if inside else None
            if run:
                k = bisect_left(earlier, run[0] + run[1] + GRAM - 1, 0, k) - 1
                continue
            now[lag] = grams = self._matched(lag) + 1
            words = grams + GRAM - 1
            if words >= 2 * lag:
                inside.append((lag, at - words - lag + 1))
            k -= 1
        for lag, grams in self.active.items():
            if lag not in now and not self._skipped(lag, at, inside):
                self._end(lag, grams)
        self.active, self.inside, self.at = now, inside, at


def find_runs(words: list[bytes]) -> list[Run]:
    """All runs of a text's words, by start, then period."""
    if len(words) < LEAST:
        return []
    numbers = word_numbers(words)
    if not _may_repeat(numbers):
        return []
    names, often = _grams(numbers)
    diagonals = _Diagonals(numbers)
    places: dict[int, list[int]] = {}
    repeated = np.flatnonzero(often[names] > 1)
    for start, name in zip(repeated.tolist(), names[repeated].tolist(), strict=True):
        earlier = places.setdefault(name, [])
        diagonals.read(start + GRAM - 1, earlier)
        earlier.append(start + GRAM - 1)
    diagonals.end_all()
    return sorted(diagonals.runs, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside of runs and of each run's first period, joined by spaces."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
        words = [words[i] for i in kept.tolist()]
    return b" ".join(words)


def _read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        at = 0
        for texts in batches(batch.column("text")):
            runs, collapsed = [], []
            for text in texts:
                words = text.split()
                found = find_runs(words)
                runs.append(found)
                collapsed.append(collapse(words, found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(at, len(texts)),
                    _run_lists(runs),
                    pa.array(collapsed, pa.binary()),
                ],
                names=["doc_id", "runs", "collapsed"],
            )
            at += len(texts)


def _run_lists(runs: list[list[Run]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, runs)])
    flat = np.array([run for some in runs for run in some], np.int64).reshape(-1, 3)
    parts = [pa.array(flat[:, i]) for i in range(3)]
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(_RUN))
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: its runs (start, length, period) and its text with each run collapsed
    to its first period."""
    found = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        _read,
        "doc_id bigint, runs array<struct<start bigint, length bigint, period bigint>>, "
        "collapsed binary",
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({_WORD})"))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """Ids and texts; the end of every tenth text, by its id, is a repetition.

    From h, the checksum of the id: with h % 10 = 0, n words and g = h / 10, the
    words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8). Rows
    without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size("words").cast("bigint")
    chosen = docs.select("doc_id", "text", g.alias("g"), (h % 10 == 0).alias("chosen"))
    words = F.when(F.col("chosen"), words_of(F.col("text")))
    a = F.when(n > 0, F.col("g") % n)
    places = chosen.withColumn("words", words).withColumn("a", a)
    period = F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1
    places = places.withColumn("period", period).withColumn("n", n)
    word = F.expr(
        "array_join(transform(sequence(0L, n - 1), i -> element_at(words, "
        "CAST(IF(i < a, i, a + (i - a) % period) AS INT) + 1)), ' ')"
    )
    text = F.when(F.col("chosen") & (F.col("n") > 0), word).otherwise(F.col("text"))
    return places.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    best = F.array_min(
        F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    columns = found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = -F.col("best.col1"), F.col("best.period")
    return columns.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
