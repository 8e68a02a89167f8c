"""Distribution profile with exact quantiles that scales out.

Spark's own exact percentile keeps all distinct values of a group in one task.
Here the values are counted and put in ranges, and ranks are found in these; of a
whole table, or of every group of one: ranges run over group and value, so a hot
group is cut into as many ranges as its values fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import fresh_path

PER_MILLE = (250, 500, 750, 950)  # quantiles, in thousandths


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows per group, column, by position, and distinct value, without nulls and NaNs.

    Equal values meet in the map-side aggregation, so a value that a third of
    all rows hold reaches the shuffle as one row per task.
    """
    values = ", ".join(f"{i}, CAST({name} AS DOUBLE)" for i, name in enumerate(columns))
    return (
        df.selectExpr(*keys, f"stack({len(columns)}, {values}) AS (metric, value)")
        .filter("value IS NOT NULL AND NOT isnan(value)")
        .groupBy(*keys, "metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def in_ranges(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The counts in ranges of (group, metric, value) of about the same size, as a table.

    Values are distinct, so a range never holds much more than another; a column
    of any spread is cut into as many. The table keeps the ranges as they are.
    """
    spark = counts.sparkSession
    path = fresh_path(spark, "value-counts")
    ranged = counts.repartitionByRange(*keys, "metric", "value")
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def summary(counts: DataFrame) -> DataFrame:
    """Count, extremes, mean and standard deviation per metric.

    Squares are taken of distances from the mean, which is known by then.
    """
    n, value = F.col("n"), F.col("value")
    first = counts.groupBy("metric").agg(
        F.sum("n").alias("n_values"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (F.sum(value * n) / F.sum("n")).alias("mean_value"),
    )
    # One row per column, so the broadcast is bounded.
    from_mean = value - F.col("mean_value")
    spread = (
        counts.join(F.broadcast(first.select("metric", "mean_value")), "metric")
        .groupBy("metric")
        .agg(F.sum(n * from_mean * from_mean).alias("spread"))
    )
    return first.join(spread, "metric").select(
        "metric",
        "n_values",
        "min_value",
        "max_value",
        "mean_value",
        F.sqrt(F.try_divide(F.col("spread"), F.col("n_values") - 1)).alias("stddev_value"),
    )


def quantiles(
    ranged: DataFrame, per_mille: Sequence[int] = PER_MILLE, keys: Sequence[str] = ()
) -> DataFrame:
    """Exact discrete quantiles per group and metric, one row each, from counts in ranges.

    A quantile is the least value that at least its share of the rows does not
    exceed. Windows run over the totals of ranges, as many as there are tasks,
    and inside the few ranges that hold a wanted rank; never over all values.
    """
    group = [*keys, "metric"]
    by_part = Window.partitionBy(*group).orderBy("part")
    parts = (
        ranged.groupBy(*group, "part")
        .agg(F.sum("n").alias("in_part"))
        .select(
            *group,
            "part",
            "in_part",
            F.sum("in_part").over(by_part).alias("upto"),
            F.sum("in_part").over(Window.partitionBy(*group)).alias("total"),
        )
    )
    wanted = F.explode(F.array(*map(F.lit, per_mille)))
    targets = (
        parts.withColumn("per_mille", wanted)
        .withColumn("rank", F.expr("greatest(1, (total * per_mille + 999) div 1000)"))
        .filter("rank <= upto AND rank > upto - in_part")
        .selectExpr(*group, "part", "per_mille", "rank - upto + in_part AS nth")
    )
    if not keys:
        # One row per metric and quantile at most, so the broadcast is bounded.
        targets = F.broadcast(targets)
    both = _join(ranged, targets, [*group, "part"])
    inside = Window.partitionBy(*group, "part", "per_mille").orderBy("value")
    return (
        both.withColumn("seen", F.sum("n").over(inside))
        .filter(F.col("seen") >= F.col("nth"))
        .groupBy(*group, "per_mille")
        .agg(F.min("value").alias("quantile"))
    )


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner join in which a null key equals a null key."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys]
    return left.join(renamed, same).drop(*(f"__{key}" for key in keys))


def group_quantiles(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], per_mille: Sequence[int] = PER_MILLE
) -> DataFrame:
    """One row per group and column that has values: their number and exact quantiles.

    No task holds a group: its distinct values are spread over ranges, and only
    the range that a wanted rank falls into is sorted. A null key is a group.
    """
    keys = list(keys)
    counts = in_ranges(value_counts(df, columns, keys), keys)
    found = quantiles(counts, per_mille, keys).groupBy(*keys, "metric")
    wide = found.agg(
        *(F.expr(f"max(IF(per_mille = {p}, quantile, NULL)) AS p{p}") for p in per_mille)
    )
    sizes = counts.groupBy(*keys, "metric").agg(F.sum("n").alias("n_values"))
    name = F.get(F.array(*map(F.lit, columns)), F.col("metric"))
    return _join(sizes, wide, [*keys, "metric"]).withColumn("metric", name)


def distribution(
    df: DataFrame, columns: Sequence[str], per_mille: Sequence[int] = PER_MILLE
) -> DataFrame:
    """One row per column: summary and quantiles `p250`, `p500` and so on."""
    counts = in_ranges(value_counts(df, columns))
    wide = (
        quantiles(counts, per_mille)
        .groupBy("metric")
        .agg(*(F.expr(f"max(IF(per_mille = {p}, quantile, NULL)) AS p{p}") for p in per_mille))
    )
    name = F.get(F.array(*map(F.lit, columns)), F.col("metric"))
    return summary(counts).join(wide, "metric").withColumn("metric", name)
