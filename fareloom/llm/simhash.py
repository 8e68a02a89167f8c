"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; two documents are linked if theirs differ in at most
two. Equal fingerprints are one entry of the index. The index has a table per
32-bit segment. If two fingerprints differ in two bits or fewer, they differ in
at most one bit of the upper segment, or not at all in the lower one. So the
Hamming ball of radius one around the upper segment (33 keys) and the lower
segment itself (1 key) are looked up, and complete distances verified in the
join. This finds every link, each once.

A key under which very many fingerprints stand would be compared with all of
them by each. For such keys the rest of the ball is enumerated too, and whole
fingerprints are looked up: at most 2,081 keys each, however many share a key.

Words are runs without ASCII white space, A-Z in lower case. A text of fewer
than three words is one shingle; one without words, and a null, has the
fingerprint zero. Rows with equal ids are documents of their own; a component
whose ids are all null has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, written
from fareloom.llm.components import components

WORDS = 3
SEED = 42
HALF = 32
HOT_KEY = 2081  # fingerprints under a key, from which whole balls are looked up instead
_BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    hashes = np.fromiter(map(digest, shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash(text: Column, words: int = WORDS) -> Column:
    """Fingerprint of a text column, as bigint."""

    @F.arrow_udf("bigint")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(
                [fingerprint(text, words) for run in batches(column) for text in run], pa.int64()
            )

    return run(F.coalesce(text, F.lit("")))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _upper(value: Column) -> Column:
    return F.shiftrightunsigned(value, HALF)


def _lower(value: Column) -> Column:
    return value.bitwiseAND((1 << HALF) - 1)


def _ball(radius: int) -> list[int]:
    """Masks of the segment's Hamming ball."""
    single = [1 << i for i in range(HALF)]
    double = [a | b for i, a in enumerate(single) for b in single[:i]]
    return [[0], [0, *single], [0, *single, *double]][radius]


def _masks(masks: list[int], shift: int = 0) -> Column:
    """An array of masks, moved up by `shift` bits, as signed numbers."""
    moved = np.array(masks, np.uint64) << np.uint64(shift)
    return F.lit(moved.view(np.int64).tolist()).cast("array<bigint>")


def links(prints: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """Pairs `u` < `v` of distinct fingerprints (`fp`) that differ in one or two bits."""
    fp = F.col("fp")
    entries = prints.select(
        fp,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("segment"), _upper(fp).alias("key")),
                F.struct(F.lit(1).alias("segment"), _lower(fp).alias("key")),
            )
        ).alias("at"),
    ).select("at.segment", "at.key", F.col("fp").alias("v"))
    probes = (
        prints.select(
            fp.alias("u"),
            F.concat(
                F.transform(
                    _masks(_ball(1)),
                    lambda mask: F.struct(
                        F.lit(0).alias("segment"), _upper(fp).bitwiseXOR(mask).alias("key")
                    ),
                ),
                F.array(F.struct(F.lit(1).alias("segment"), _lower(fp).alias("key"))),
            ).alias("at"),
        )
        .select("u", F.explode("at").alias("at"))
        .select("u", "at.segment", "at.key")
    )
    hot = entries.groupBy("segment", "key").count().where(F.col("count") > hot_key)
    hot = written(hot.select("segment", "key"), "hot-keys")
    if not hot.isEmpty():
        crowded = probes.join(hot, ["segment", "key"], "left_semi")
        probes = probes.join(hot, ["segment", "key"], "left_anti")
        found = _whole_balls(crowded, prints)
    else:
        found = None
    u, v = F.col("u"), F.col("v")
    upper_bits = F.bit_count(_upper(u).bitwiseXOR(_upper(v)))
    fits = (
        (u < v)
        & (F.bit_count(u.bitwiseXOR(v)) <= 2)
        & ((F.col("p.segment") == 0) | (upper_bits == 2))
    )
    p, e = probes.alias("p"), entries.alias("e")
    same = (F.col("p.segment") == F.col("e.segment")) & (F.col("p.key") == F.col("e.key"))
    near = p.join(e, same & fits).select("u", "v")
    return near if found is None else near.unionByName(found)


def _whole_balls(crowded: DataFrame, prints: DataFrame) -> DataFrame:
    """Links of probes under crowded keys, by looking up whole fingerprints."""
    u = F.col("u")
    own, beside = _masks(_ball(2)), _masks(_ball(1))
    above = _masks([m for m in _ball(2) if m.bit_count() == 2], HALF)
    moved = F.shiftleft(F.col("key").bitwiseXOR(_upper(u)), HALF)
    masks = (
        F.when(F.col("segment") == 1, above)
        .when(moved == 0, own)
        .otherwise(F.transform(beside, lambda m: m.bitwiseXOR(moved)))
    )
    wanted = crowded.select("u", F.explode(masks).alias("mask"))
    wanted = wanted.select("u", u.bitwiseXOR(F.col("mask")).alias("v")).where("u < v")
    return wanted.join(prints.select(F.col("fp").alias("v")), "v").select("u", "v")


def near_groups(docs: DataFrame, words: int = WORDS, hot_key: int = HOT_KEY) -> DataFrame:
    """Per document: fingerprint, smallest id of its component, and the component's
    own fingerprint (`component`), which names it where ids are null."""
    prints = written(docs.select("doc_id", simhash(F.col("text"), words).alias("fp")), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct, hot_key))
    member = distinct.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left")
    member = member.select("fp", F.coalesce("v", "fp").alias("component"), "first")
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    member = written(member.select("fp", "component").join(least, "component"), "members")
    return prints.join(member, "fp").select(
        "doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id",
        as_hex(F.col("component")).alias("component"),
    )
