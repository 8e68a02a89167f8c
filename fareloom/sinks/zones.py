"""A zone map of raw files: the least and greatest pickup in each.

It is a table beside raw, partitioned alike, so the zones of replaced partitions
are replaced with them. A month of pickup is then computed from those files only
whose zone meets it, however long the fleet's history is. Zones are a hint: a
raw file without one is read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import FLEET, MONTH, PICKUP, YEAR
from fareloom.sinks.journal import SCHEMA, Month
from fareloom.sinks.tables import Lake, plain_path, spellings

ZONES = "raw_zones"
_PATH = "path"


def file_path() -> F.Column:
    return F.col("_metadata.file_path")


def zones(rows: DataFrame, *keys: str) -> DataFrame:
    """Per file: least and greatest pickup, and rows; reads one column."""
    return rows.groupBy(*keys, _PATH).agg(
        F.min(PICKUP).alias("first_pickup"),
        F.max(PICKUP).alias("last_pickup"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def remember(lake: Lake, found: DataFrame, keys: Iterable[str]) -> None:
    """Store zones, in place of those of the same partitions."""
    keys = list(keys)
    if lake.has(ZONES):
        lake.write_partitions(ZONES, found)
    else:
        lake.write(ZONES, found, keys)


def files_of(lake: Lake, months: Iterable[Month], layer: str = "raw") -> list[str]:
    """Raw files that may hold trips of these fleets' months.

    The driver sees the names of the layer's files, as Spark's own listing does.
    """
    present = {plain_path(path): path for path in lake.read(layer).inputFiles()}
    if not lake.has(ZONES):
        return sorted(present.values())
    wanted = lake.spark.createDataFrame(sorted(months), SCHEMA).select(
        F.col(FLEET).alias("__fleet"), F.make_timestamp_ntz(
            YEAR, MONTH, F.lit(1), F.lit(0), F.lit(0), F.lit(0)
        ).alias("__first")
    )
    known = lake.read(ZONES)
    # One row per month to refresh, so the join is with a few rows at most.
    meets = (
        (F.col(FLEET) == F.col("__fleet"))
        & (F.col("last_pickup") >= F.col("__first"))
        & (F.col("first_pickup") < F.col("__first") + F.expr("INTERVAL '1' MONTH"))
    )
    apart = known.join(wanted, meets, "left_anti").select(_PATH)
    out = {plain_path(row[_PATH]) for row in apart.collect()}
    return sorted(path for plain, path in present.items() if plain not in out)


def rows_of(lake: Lake, months: Iterable[Month], layer: str = "raw") -> DataFrame:
    """The layer, read from the files that may hold trips of these months."""
    names = [name for path in files_of(lake, months, layer) for name in spellings(path)]
    return lake.read(layer).where(file_path().isin(*names))
