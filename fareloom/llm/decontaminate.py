"""Benchmark decontamination: containment search by MinHash, partitioned by size.

Items and documents are sets of five-word shingles. An item is contained in a
document if at least 0.8 of its shingles are in it. Shingles are ordered by
hash (the MinHash order). Items are partitioned by size, in powers of two, and
every item of a partition keeps the same number of its least hashes: one more
than may be missing from the largest item of the partition. So a document that
contains an item has at least one of them, whatever the document's length, and
the search misses nothing. From a document only hashes up to the largest one
kept by any item are looked up. Pairs found are verified on the shingles'
words, for the documents found alone.

Words are runs of letters and digits in lower case. An item of fewer than five
words is one shingle, and is looked for as that. An item without words, and a
null text, contain nothing and are contained in nothing. Documents and items are
told apart by id and text; rows that repeat both give one row, and texts that
share an id are each looked for. An item or document without an id is one too,
and has a null id in the result. Texts of any length are read whole; without
documents or items there are no rows; extra columns are left out, whatever their
names. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import written

WORDS = 5
SHARE = 0.8


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.expr("array()"))


def read_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column out of a one-row generator. A plain projection would be copied
    into what refers to it, and be worked out again for every place of a text."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _per_start(found: str, size: int, shingle: str) -> Column:
    """An expression per place of a run of `size` words; `i` is the place."""
    starts = f"sequence(1, size({found}) - {size - 1})"
    return F.expr(
        f"IF(size({found}) >= {size}, transform({starts}, i -> {shingle}), array())"
    )


def hashes(found: str, size: int = WORDS) -> Column:
    return _per_start(found, size, f"xxhash64(slice({found}, i, {size}))").cast("array<bigint>")


def _upto(values: Column, most: int) -> Column:
    return F.filter(values, lambda h: h <= most)


def shingles(found: str, size: int = WORDS) -> Column:
    text = f"array_join(slice({found}, i, {size}), ' ')"
    return F.array_distinct(_per_start(found, size, text).cast("array<string>"))


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    """Items, each once, with a key, their shingle length, shingles and hashes."""
    own = benchmark.select("item_id", "text").distinct()
    own = own.withColumn("item_key", F.xxhash64(F.col("item_id").isNull(), "item_id", "text"))
    own = read_once(own, "w", words(F.col("text"))).where("size(w) > 0")
    width = F.least(F.size("w"), F.lit(size))
    by_width = [
        own.where(width == n).select(
            "item_id", "item_key", F.lit(n).alias("width"), shingles("w", n).alias("item_shingles"),
            F.array_distinct(hashes("w", n)).alias("h"),
        )
        for n in range(1, size + 1)
    ]
    whole = by_width[0]
    for part in by_width[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("q", F.size("item_shingles"))


def _sketches(items: DataFrame, share: float) -> DataFrame:
    """The least hashes of each item, as many as its size partition asks for."""
    missing = F.floor((F.lit(1) - F.lit(share)) * (F.pow(F.lit(2.0), F.col("size_class") + 1) - 1) + 1e-9)
    classed = items.withColumn("size_class", F.floor(F.log2(F.col("q").cast("double")) + 1e-9))
    kept = F.slice(F.array_sort("h"), F.lit(1), (missing + 1).cast("int"))
    return classed.select("item_key", "width", "q", F.explode(kept).alias("h"))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, size: int = WORDS, share: float = SHARE
) -> DataFrame:
    """Pairs of document and contained item: `doc_id`, `text_hash`, `item_id`,
    `n_item` and `n_found` (shingles), and `containment`."""
    items = _items(benchmark, size)
    sketches = _sketches(items, share)
    # One number per shingle length: at most `size` rows.
    bounds = {
        row["width"]: row["most"]
        for row in sketches.groupBy("width").agg(F.max("h").alias("most")).collect()
    }
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    ).where("text IS NOT NULL")
    read = read_once(keyed, "w", words(F.col("text"))).select("doc_id", "text_hash", "w")
    found = None
    for width, most in sorted(bounds.items()):
        looked_up = read.select(
            "doc_id",
            "text_hash",
            F.greatest(F.size("w") - (width - 1), F.lit(0)).alias("places"),
            F.explode(_upto(hashes("w", width), most)).alias("h"),
        )
        own = sketches.where(F.col("width") == width).select("item_key", "q", "h")
        hits = looked_up.join(own, "h").where(F.col("places") >= F.ceil(F.col("q") * share - 1e-9))
        hits = hits.select("doc_id", "text_hash", "item_key").distinct()
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        none = F.lit(None).cast("bigint")
        found = keyed.select("doc_id", "text_hash", none.alias("item_key")).where(F.lit(False))
    # Written, so that its size is known before the documents' texts are moved: few
    # pairs go to the texts, and only many make it a join of two shuffled sides.
    found = written(found, "found-pairs")
    return _verified(found, keyed, items, share, sorted(bounds) or [size])


def _verified(found, keyed, items, share, widths) -> DataFrame:
    """Exact containment of the pairs found; only their documents' words are read."""
    same = F.col("f.doc_id").eqNullSafe(F.col("k.doc_id")) & (
        F.col("f.text_hash") == F.col("k.text_hash")
    )
    pairs = (
        found.alias("f")
        .join(keyed.alias("k"), same)
        .select("f.doc_id", "f.text_hash", "f.item_key", "k.text")
        .join(items.select("item_id", "item_key", "width", "q", "item_shingles"), "item_key")
    )
    pairs = read_once(pairs, "w", words(F.col("text")))
    own = F.lit(None).cast("array<string>")
    for width in widths:
        own = F.when(F.col("width") == width, shingles("w", width)).otherwise(own)
    counted = pairs.select(
        "doc_id",
        "text_hash",
        "item_id",
        "item_key",
        F.col("q").cast("bigint").alias("n_item"),
        F.size(F.array_intersect("item_shingles", own)).cast("bigint").alias("n_found"),
    )
    containment = F.col("n_found") / F.col("n_item")
    enough = F.col("n_found") >= F.col("n_item") * share - 1e-9
    found = counted.withColumn("containment", containment).where(enough)
    return found.dropDuplicates(["doc_id", "text_hash", "item_key"]).drop("item_key")
