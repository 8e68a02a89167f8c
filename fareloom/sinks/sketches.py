"""Quantile sketches per partition of a layer, merged when read.

A sketch (Spark's own KLL aggregate) has a bounded size whatever the partition's,
and sketches of partitions merge into that of any union of them. So quantiles of
a year or a fleet need no row, and a refresh builds those of touched partitions
only. The share of rows up to an estimate differs from the wanted one by less
than `RANK_ERROR`. The exact form is `operators.distribution`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import AMOUNT, DISTANCE, DURATION, PARTITIONING
from fareloom.sinks.tables import Lake

SIZE = 1000  # the sketch's accuracy parameter
RANK_ERROR = 0.01
SKETCHES = "silver_sketches"
MEASURED = (AMOUNT, DISTANCE, DURATION)


def sketch(rows: DataFrame, keys: Sequence[str], columns: Sequence[str] = MEASURED) -> DataFrame:
    """A sketch per partition and column, without nulls and NaNs; one pass."""
    values = (F.nanvl(F.col(name).cast("double"), F.lit(None)) for name in columns)
    return rows.groupBy(*keys).agg(
        *(
            F.kll_sketch_agg_double(value, F.lit(SIZE)).alias(name)
            for name, value in zip(columns, values, strict=True)
        )
    )


def build(lake: Lake, layer: str = "silver", months: Iterable[tuple] | None = None) -> None:
    """Store the sketches of a layer's partitions; only of some months if given.

    Partitions that the layer has no more lose their sketches.
    """
    rows, keys = lake.read(layer), list(PARTITIONING)
    if months is None or not lake.has(SKETCHES):
        lake.write(SKETCHES, sketch(rows, keys), keys)
        return
    months = set(months)
    chosen = F.lit(False)
    for values in sorted(months):
        same = [F.col(key) == value for key, value in zip(keys, values, strict=True)]
        chosen = chosen | (same[0] & same[1] & same[2])
    report = lake.write_partitions(SKETCHES, sketch(rows.where(chosen), keys))
    left = {
        (fleet, int(year), int(month))
        for fleet, year, month in lake.partitions_below(SKETCHES, report.path)
    }
    lake.drop_partitions(SKETCHES, sorted(months - left))


def estimates(
    sketches: DataFrame, per_mille: Sequence[int], keys: Sequence[str] = (), columns=MEASURED
) -> DataFrame:
    """Estimated quantiles per group of partitions and column: `n_values`, `quantiles`."""
    merged = sketches.groupBy(*keys).agg(
        *(F.kll_merge_agg_double(name).alias(name) for name in columns)
    )
    ranks = F.array(*(F.lit(p / 1000) for p in per_mille))
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.kll_sketch_get_n_double(name).alias("n_values"),
            F.when(
                F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, ranks)
            ).alias("quantiles"),
        )
        for name in columns
    ]
    return merged.select(*keys, F.inline(F.array(*rows)))
