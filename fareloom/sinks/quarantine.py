"""Rows that a layer rejects, kept beside it with the reasons.

Both tables come out of one write over one scan: rows go to folders by whether
they are rejected, and each table is pointed to its own. So kept and rejected
rows always add up to what was read, partition by partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import PARTITIONING
from fareloom.operators.quality import REASONS
from fareloom.sinks.tables import Lake, WriteReport

REJECTED = "rejected"


def rejects(layer: str) -> str:
    return f"{layer}_rejects"


def divide(
    lake: Lake,
    layer: str,
    judged: DataFrame,
    rebalance: bool = False,
    keys: Sequence[str] = PARTITIONING,
) -> dict[str, WriteReport]:
    """Replace a layer and its rejects by judged rows, in one write.

    With `rebalance`, rows are shuffled to their partitions first (as in `write`).
    A row whose partition values cannot be told, as its pickup is null, is in the
    rejects' null partition. A later `refresh_partitions` replaces the layer's rows
    only: rejects are those of the last whole refresh.
    """
    routed = judged.withColumn(REJECTED, F.col(REASONS).isNotNull())
    if rebalance:
        routed = routed.hint("rebalance", REJECTED, *keys)
    path, counts = lake.store(
        layer, routed, (REJECTED, *keys), rejected=F.count_if(REJECTED)
    )
    rows = {"true": counts["rejected"], "false": counts["rows"] - counts["rejected"]}
    schemas = {"true": judged.schema, "false": judged.drop(REASONS).schema}
    reports = {}
    for name, side in ((layer, "false"), (rejects(layer), "true")):
        folder = f"{path}/{REJECTED}={side}"
        if not rows[side]:  # the write left no folder
            nothing = lake.spark.createDataFrame([], schemas[side])
            nothing.write.partitionBy(*keys).parquet(folder)
        reports[name] = lake.adopt(name, schemas[side], keys, folder, rows[side])
    return reports
