"""Document fingerprints by a randomised edit embedding.

A shared random walk reads the characters of a text: at place j of its output a
random bit of (j, character) says whether the walk goes on to the next
character after writing the present one. Texts a few edits apart soon fall into
step again, so few edits become few differing places (Hamming distance) of the
output. Bits, repeated after 1,024 places, are stated as an automaton: a place
and a character give the next place at once.

A fingerprint has 128 bytes. Byte k is a hash of the character at one place of
the output below twice the length of the text. Places are drawn once, as a
function of the length that seldom changes, so texts of about the same length
are sampled at the same places. Likeness is the share of equal bytes. For a
search, bands of bytes are compared exactly, and pairs that share a band are
verified.

Whole texts are read; characters are code points. A null text is empty; the
fingerprint of an empty text is that of no character at every place, and two
empty texts are alike (1). Equal texts have equal fingerprints. The next
document is that of the next smaller id (after the smallest, that of the
largest). Rows with equal ids follow each other by the hash of their text; rows
without an id come last, and repeated rows are rows each. An empty table gives an
empty one; extra columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate
from math import floor
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, written

PERIOD = 1024
LETTERS = 256
LENGTH = 128  # bytes of a fingerprint
BANDS, BAND_BYTES = 32, 4
LIKE = 0.8
NOTHING = LETTERS  # the sampled character where a text has no place
_SEED = 20_240_229
_GROWTH = 1.5  # a byte changes its place a few times per doubling of the length


def _automaton() -> list[list]:
    """A row per place; entry c is the row after character c, the last the place."""
    random = np.random.default_rng(_SEED)
    going = random.integers(0, 2, (2 * PERIOD, LETTERS), dtype=np.int8)
    going[PERIOD:] = going[:PERIOD]
    # The walk leaves a character at its first set bit at or after the present place.
    leaves = np.full((2 * PERIOD + 1, LETTERS), 2 * PERIOD, np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        leaves[j] = np.where(going[j], j, leaves[j + 1])
    rows: list[list] = [[] for _ in range(PERIOD)]
    for j in range(PERIOD):
        rows[j].extend(rows[x] for x in ((leaves[j] + 1) % PERIOD).tolist())
        rows[j].append(j)
    return rows


class Samples:
    """The sampled place of each byte as a step function of the output's length.

    The candidates of a byte are the first eight places and eight random ones
    between any two of a growing row of bounds. Each has an exponential clock
    whose rate is the number of places it stands for; the first to ring below
    the length is sampled, so every place is about equally likely. As a length
    grows, a byte changes its place only when a new candidate rings earlier
    than all before it: a handful of records, which are kept.
    """

    def __init__(self, longest: int = 1 << 33):
        bounds = [8]
        while bounds[-1] < longest:
            bounds.append(int(bounds[-1] * _GROWTH) + 1)
        random = np.random.default_rng(_SEED + 1)
        pairs = list(zip(bounds, bounds[1:], strict=False))
        first = np.broadcast_to(np.arange(8), (LENGTH, 8))
        later = [np.sort(random.integers(low, high, (LENGTH, 8)), axis=1) for low, high in pairs]
        places = np.concatenate([first, *later], axis=1)
        rates = np.repeat([1.0, *((high - low) / 8 for low, high in pairs)], 8)
        clocks = -np.log1p(-random.random(places.shape)) / rates
        before = np.minimum.accumulate(clocks, axis=1)
        record = np.ones(places.shape, bool)
        record[:, 1:] = clocks[:, 1:] < before[:, :-1]
        self.records = np.full((LENGTH, record.sum(axis=1).max()), np.iinfo(np.int64).max)
        for byte in range(LENGTH):
            found = places[byte, record[byte]]
            self.records[byte, : len(found)] = found

    def at(self, length: int) -> np.ndarray:
        """One place below `length` for each byte."""
        return np.where(self.records < length, self.records, 0).max(axis=1)


class Embedding:
    """Walks and fingerprints; built once per worker."""

    def __init__(self):
        self.rows = _automaton()
        self.samples = Samples()

    def classes(self, text: str) -> bytes:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(56)).astype(np.uint8).tobytes()

    def walk(self, letters: bytes, place: int = 0) -> np.ndarray:
        """Where the output of each character ends, from a place on."""
        states = accumulate(letters, getitem, initial=self.rows[place % PERIOD])
        phase = np.fromiter(map(itemgetter(LETTERS), states), np.int64, len(letters) + 1)
        steps = np.diff(phase)
        steps[steps <= 0] += PERIOD
        return place + np.cumsum(steps)

    def sample(self, letters: bytes, ends: np.ndarray) -> bytes:
        n = len(letters)
        if not n:
            seen = np.full(LENGTH, NOTHING, np.int64)
        else:
            at = np.searchsorted(ends, self.samples.at(2 * n), side="right")
            padded = np.append(np.frombuffer(letters, np.uint8).astype(np.int64), NOTHING)
            seen = padded[np.minimum(at, n)]
        byte = (seen * 0x9E3779B1 + np.arange(LENGTH) * 0x85EBCA77) >> 11
        return (byte & 255).astype(np.uint8).tobytes()

    def fingerprint(self, text: str) -> bytes:
        letters = self.classes(text)
        return self.sample(letters, self.walk(letters))


_embedding: list[Embedding] = []


def embedding() -> Embedding:
    if not _embedding:
        _embedding.append(Embedding())
    return _embedding[0]


def likeness(a: bytes, b: bytes) -> float:
    equal = np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)
    return float(equal.mean())


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column, as binary."""

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = embedding()
        for column in columns:
            texts = (t.decode("utf-8", "replace") for run in batches(column) for t in run)
            yield pa.array([embed.fingerprint(t) for t in texts], pa.binary())

    return run(F.coalesce(text, F.lit("")))


def _equal_bytes(a: Column, b: Column) -> Column:
    """Number of equal bytes of two fingerprints, as columns of four-byte words."""
    low, high = 0x7F7F7F7F, 0x80808080
    total = F.lit(0)
    for i in range(LENGTH // 4):
        x = a[i].bitwiseXOR(b[i])
        differ = (x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high)
        total = total + 4 - F.bit_count(differ)
    return total


def _words(print_: Column) -> Column:
    text = F.hex(print_)
    parts = (F.conv(F.substring(text, 8 * i + 1, 8), 16, 10) for i in range(LENGTH // 4))
    return F.array(*(part.cast("bigint") for part in parts))


def _rare_bands(classes: DataFrame, like: float) -> DataFrame:
    """Bands (`fp`, `band`) by which classes that are alike meet.

    Two fingerprints that differ in at most so many bytes share all bands but as
    many. So with all bands in one order, the rarest first, they share one among
    the first of either; what very many have in common is left out of those.
    """
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("fp", i * BAND_BYTES + 1, BAND_BYTES)),
    )
    entries = written(classes.select("fp", F.explode(bands).alias("band")), "edit-bands")
    often = entries.groupBy("band").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    times = F.coalesce("times", F.lit(1)).alias("times")
    ranked = entries.join(often, "band", "left").groupBy("fp")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct(times, "band"))).alias("order"))
    shared = BANDS - floor(LENGTH * (1 - like) + 1e-9)
    first = F.slice("order", 1, BANDS - max(shared, 1) + 1)
    met = F.filter(first, lambda x: x["times"] > 1)
    return ranked.select("fp", F.explode(met).alias("at")).select("fp", "at.band")


def near_pairs(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """Links between classes of documents with one fingerprint: the fingerprints `u` <
    `v`, the smallest id of either (`u_id`, `v_id`; null if all are) and their likeness.

    Two fingerprints are compared if one of 32 bands of four sampled bytes is
    equal in both, of the rarest that two alike ones have to share (26 at 0.8):
    no pair is missed down to a likeness of 0.76. Likeness is part of the join's
    condition, so only links leave it.
    """
    prints = docs.select("doc_id", fingerprint(F.col("text")).alias("fp"))
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "edit-classes")
    banded = _rare_bands(classes, like).join(classes, "fp")
    banded = written(banded.withColumn("words", _words(F.col("fp"))), "edit-banded")
    a, b = banded.alias("a"), banded.alias("b")
    equal = _equal_bytes(F.col("a.words"), F.col("b.words"))
    near = (F.col("a.band") == F.col("b.band")) & (F.col("a.fp") < F.col("b.fp"))
    pairs = a.join(b, near & (equal >= like * LENGTH))
    return pairs.select(
        F.lower(F.hex("a.fp")).alias("u"), F.lower(F.hex("b.fp")).alias("v"),
        F.col("a.id").alias("u_id"), F.col("b.id").alias("v_id"), (equal / LENGTH).alias("likeness"),
    ).distinct()


class Read:
    """A text with its walk and fingerprint."""

    def __init__(self, text: str, embed: Embedding):
        self.text, self.letters = text, embed.classes(text)
        self.ends = embed.walk(self.letters)
        self.print = embed.sample(self.letters, self.ends)


def edited(own: Read, after: Read, embed: Embedding) -> dict:
    """What is told about a document and its next one.

    The second half of the edited text is the start of the next document; its
    walk goes on where the walk of the first half ends.
    """
    n = len(own.text)
    kept = n - n // 2
    text = own.text[:kept] + after.text[: n // 2]
    letters = own.letters[:kept] + after.letters[: n // 2]
    place = int(own.ends[kept - 1]) if kept else 0
    ends = np.concatenate([own.ends[:kept], embed.walk(letters[kept:], place)])
    print_ = embed.sample(letters, ends)
    return {
        "n_chars": n,
        "edited_sha256": sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own.print,
        "edited_fingerprint": print_,
        "near_edited": likeness(own.print, print_),
        "near_next": likeness(own.print, after.print),
    }


_FOUND = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
_EDGE = {"part": pa.int32(), "edge": pa.string(), "text": pa.string()}
_TYPES = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_EDGE_TYPES = f"{_TYPES}, part int, edge string, text string"
_OUT_ROWS = 500


def _batch(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(name) for row in rows], kind) for name, kind in kinds.items()],
        names=list(kinds),
    )


def _along(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of an ordered partition with its follower; the first and the
    last one also as edges, with their texts."""
    embed, kinds = embedding(), _FOUND | _EDGE
    part = TaskContext.get().partitionId()
    last: tuple | None = None
    out: list[dict] = []
    for batch in rows:
        ids = iter(batch.column("doc_id").to_pylist())
        for run in batches(batch.column("text")):
            for data in run:
                now = (next(ids), Read(data.decode("utf-8", "replace"), embed))
                if last is None:
                    out.append({"part": part, "edge": "first", "text": now[1].text})
                else:
                    out.append({"doc_id": last[0], **edited(last[1], now[1], embed)})
                last = now
                if len(out) >= _OUT_ROWS:
                    yield _batch(out, kinds)
                    out = []
    if last is not None:
        out.append({"part": part, "edge": "last", "doc_id": last[0], "text": last[1].text})
        yield _batch(out, kinds)


def _across(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for pairs of texts in one row."""
    embed = embedding()
    for batch in rows:
        out = []
        for row in batch.to_pylist():
            own, after = Read(row["text"], embed), Read(row["after"], embed)
            out.append({"doc_id": row["doc_id"], **edited(own, after, embed)})
        yield _batch(out, _FOUND)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and its likeness to its edited text and to
    the next document in the order of falling ids.

    Texts are shuffled once, into ranges of ids, and read in order with one text
    kept. The last text of a range meets the first of the next range in a join
    of one row per range.
    """
    spark = docs.sparkSession
    order = [F.desc_nulls_last("doc_id"), F.asc("hash")]
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Range bounds are sampled on the driver: from ids and hashes, not from texts.
    whole = whole.withColumn("hash", F.xxhash64("text"))
    ranges = whole.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(ranges.mapInArrow(_along, _EDGE_TYPES), "edit-neighbours")
    edges = found.where("edge IS NOT NULL")
    parts = sorted(row["part"] for row in edges.where("edge = 'first'").select("part").collect())
    follow = list(zip(parts, parts[1:] + parts[:1], strict=True))
    following = spark.createDataFrame(follow, "part int, next int")
    heads = edges.where("edge = 'first'").select(
        F.col("part").alias("next"), F.col("text").alias("after")
    )
    tails = edges.where("edge = 'last'").select("part", "doc_id", "text")
    pairs = tails.join(following, "part").join(heads, "next").select("doc_id", "text", "after")
    inner = found.where("edge IS NULL").select(*_FOUND)
    return inner.unionByName(pairs.mapInArrow(_across, _TYPES)).withColumns(
        {
            name: F.lower(F.hex(name))
            for name in ("fingerprint", "edited_fingerprint")
        }
    )
