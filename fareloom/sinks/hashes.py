"""A hash tree over a layer: table, partitions, files.

A file's hash is the sum of its rows' hashes, a partition's the sum of its files'
and a table's that of its partitions, so the order of rows and the cut into files
do not matter above the file. Two states are compared from the top: equal tables
end it, then equal partitions are left out, then equal files. Files of a layer
never change once written, so a snapshot reads only files that an earlier one
does not know.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.profile import row_hash
from fareloom.sinks.tables import Lake, plain_path, spellings

_SUM = "decimal(38,0)"


def file_hashes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and hash of every file that rows come from, with its partition."""
    hashed = rows.select(*keys, F.col("_metadata.file_path").alias("path"), row_hash(rows).alias("h"))
    return hashed.groupBy(*keys, "path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("h").cast(_SUM).alias("hash")
    )


def snapshot(lake: Lake, layer: str, before: str | None = None) -> str:
    """Store the leaves of a layer's tree as it is now, and return the folder.

    `before` is an earlier snapshot: what it knows of files that are still there is
    taken over, and these are not read. The driver sees the names of files.
    """
    spark, keys = lake.spark, lake.partitioning(layer)
    present = {plain_path(path): path for path in lake.read(layer).inputFiles()}
    rows, kept = lake.read(layer), None
    if before:
        old = spark.read.parquet(before)
        known = {plain_path(row["path"]): row["path"] for row in old.select("path").collect()}
        there = [(path,) for plain, path in known.items() if plain in present]
        kept = old.join(spark.createDataFrame(there, "path string"), "path", "left_semi")
        new = [path for plain, path in present.items() if plain not in known]
        names = [name for path in new for name in spellings(path)]
        rows = rows.where(F.col("_metadata.file_path").isin(*names))
    leaves = file_hashes(rows, keys)
    leaves = leaves.unionByName(kept) if kept is not None else leaves
    folder = f"{lake.location.rstrip('/')}/snapshots/{lake.name(layer)}-{uuid4().hex[:12]}"
    leaves.coalesce(max(1, len(present) // 100_000)).write.parquet(folder)
    return folder


def level(leaves: DataFrame, *keys: str) -> DataFrame:
    """The tree at a level: without keys the table, with the partition keys partitions."""
    return leaves.groupBy(*keys).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("hash"), F.lit(0)).cast(_SUM).alias("hash"),
        F.count(F.lit(1)).alias("n_files"),
    )


def _differing(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of groups that are not the same in both."""
    marked = [
        level(leaves, *keys).select(*keys, "n_rows", "hash", F.lit(side).alias("side"))
        for side, leaves in ((1, one), (2, other))
    ]
    both = marked[0].unionByName(marked[1])
    alone = both.groupBy(*keys, "n_rows", "hash").agg(F.count(F.lit(1)).alias("sides"))
    return alone.where("sides < 2").select(*keys).distinct()


def differences(spark: SparkSession, before: str, after: str, keys: Sequence[str]) -> DataFrame:
    """Files that hold what differs between two snapshots: partition, path, rows, `side`.

    `side` is `before` or `after`. A file whose content the other snapshot has too,
    in the same partition under whatever name, is not among them.
    """
    one, other = spark.read.parquet(before), spark.read.parquet(after)
    tops = [tuple(level(leaves).first()[:2]) for leaves in (one, other)]
    empty = one.select(*keys, "path", "n_rows", F.lit("before").alias("side")).where(F.lit(False))
    if tops[0] == tops[1]:
        return empty
    if keys:
        changed = _differing(one, other, keys).withColumnsRenamed({k: f"__{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        one, other = (leaves.join(changed, same, "left_semi") for leaves in (one, other))
    parts = []
    for side, own, against in (("before", one, other), ("after", other, one)):
        content = [*keys, "n_rows", "hash"]
        twin = against.select(*(F.col(c).alias(f"__{c}") for c in content))
        alike = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in content]
        left = own.join(twin, alike, "left_anti")
        parts.append(left.select(*keys, "path", "n_rows", F.lit(side).alias("side")))
    return parts[0].unionByName(parts[1])


def changed_rows(lake: Lake, layer: str, files: DataFrame) -> DataFrame:
    """Rows that only one of two states has, with their `side`, out of files that differ.

    Only those files are read. Those of the earlier state are there until `expire`.
    """
    keys, schema = lake.partitioning(layer), lake.read(layer).schema
    sides = {"before": [], "after": []}
    for row in files.select("path", "side").collect():  # a name per differing file
        sides[row["side"]].append(row["path"])
    found = {}
    for side, paths in sides.items():
        by_version: dict[str, list[str]] = {}
        for path in paths:
            base = path.rsplit("/", len(keys) + 1)[0]
            by_version.setdefault(base, []).append(path)
        rows = lake.spark.createDataFrame([], schema)
        for base, some in by_version.items():
            rows = rows.unionByName(
                lake.spark.read.schema(schema).option("basePath", base).parquet(*some)
            )
        found[side] = rows
    parts = [
        found[side].exceptAll(found[other]).withColumn("side", F.lit(side))
        for side, other in (("before", "after"), ("after", "before"))
    ]
    return parts[0].unionByName(parts[1])
