"""Trip files as they arrive: the same layer functions over file streams.

Cleaning and enriching look at one row at a time, so they need no state. The
rollup keeps one state row per cell, which fleets, months, hours and weekdays
bound; it does not grow with the trips.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fareloom.contract import FLEETS, PARTITIONING, Fleet
from fareloom.operators.unify import standardize, union_all
from fareloom.plans.medallion import Layers
from fareloom.sinks.tables import Lake
from fareloom.sources.landing import with_provenance


def arriving_trips(
    spark: SparkSession,
    folders: Mapping[str, tuple[str, StructType]],
    files_per_batch: int | None = None,
    extra=(),
) -> DataFrame:
    """One unified stream from a folder (and its file schema) per fleet."""
    streams = []
    for name, (folder, schema) in folders.items():
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        fleet = FLEETS.get(name, Fleet(name))
        streams.append(standardize(with_provenance(reader.parquet(folder), fleet), fleet, extra))
    return union_all(streams)


def append_silver(
    unified: DataFrame, path: str, checkpoint: str, layers: Layers | None = None
) -> StreamingQuery:
    """Add the plausible trips of all new files to a partitioned folder, once."""
    layers = layers or Layers()
    return (
        layers.silver(layers.bronze(unified))
        .writeStream.format("parquet")
        .partitionBy(*PARTITIONING)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_gold(
    unified: DataFrame, lake: Lake, checkpoint: str, layers: Layers | None = None
) -> StreamingQuery:
    """Bring the gold table up to date with all new files.

    Every batch hands over the whole rollup, which replaces the table; a batch
    that runs twice after a failure leaves the same table. Before that, what
    earlier batches wrote and the table no longer uses is deleted.
    """
    layers = layers or Layers()

    def replace(gold: DataFrame, _: int) -> None:
        if "gold" in lake.existing():
            lake.expire("gold")
        lake.write("gold", gold)

    return (
        layers.gold_from(unified)
        .writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
