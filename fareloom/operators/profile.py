"""Quality profiling: what a table holds, rule by rule and column by column.

Every report is one aggregation over one scan, turned into rows afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.contract import AMOUNT, BOUNDS, DROPOFF, PASSENGERS, PICKUP, Bound
from fareloom.operators.quality import Rule, failed_mask, rule_names


def to_rows(wide: DataFrame, records: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per record."""
    structs = [F.struct(*(value.alias(name) for name, value in r.items())) for r in records]
    return wide.select(F.inline(F.array(*structs)))


def rate(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 6)


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and NaNs per column, counted apart, with the null rate."""
    names = list(columns or df.columns)
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in names),
        *(F.count_if(F.isnan(name)).alias(f"nan_{name}") for name in names if name in floating),
    )
    return to_rows(
        wide,
        [
            {
                "column_name": F.lit(name),
                "n_rows": F.col("n_rows"),
                "n_null": F.col(f"null_{name}"),
                "n_nan": F.col(f"nan_{name}") if name in floating else F.lit(0).cast("bigint"),
                "null_rate": rate(F.col(f"null_{name}"), F.col("n_rows")),
            }
            for name in names
        ],
    )


def range_validity(df: DataFrame, bounds: Mapping[str, Bound] = BOUNDS) -> DataFrame:
    """Per bounded column: values below, inside and above its bound."""
    wide = df.agg(
        *(F.count(name).alias(f"n_{name}") for name in bounds),
        *(F.count_if(F.col(name) < b.low).alias(f"below_{name}") for name, b in bounds.items()),
        *(F.count_if(F.col(name) > b.high).alias(f"above_{name}") for name, b in bounds.items()),
    )
    records = []
    for name, bound in bounds.items():
        n, below, above = (F.col(f"{prefix}_{name}") for prefix in ("n", "below", "above"))
        records.append(
            {
                "column_name": F.lit(name),
                "low": F.lit(float(bound.low)),
                "high": F.lit(float(bound.high)),
                "n_checked": n,
                "n_below": below,
                "n_above": above,
                "valid_rate": rate(n - below - above, n),
            }
        )
    return to_rows(wide, records)


def outliers(df: DataFrame, bounds: Mapping[str, Bound] = BOUNDS) -> DataFrame:
    """Outliers among fares and passenger counts, with the extreme values."""
    watched = (AMOUNT, PASSENGERS)
    wide = df.agg(
        *(
            F.count_if(~F.col(name).between(bounds[name].low, bounds[name].high)).alias(f"n_{name}")
            for name in watched
        ),
        *(F.min(name).alias(f"min_{name}") for name in watched),
        *(F.max(name).alias(f"max_{name}") for name in watched),
    )
    return to_rows(
        wide,
        [
            {
                "column_name": F.lit(name),
                "n_outliers": F.col(f"n_{name}"),
                "min_value": F.col(f"min_{name}"),
                "max_value": F.col(f"max_{name}"),
            }
            for name in watched
        ],
    )


def time_consistency(df: DataFrame, *keys: str) -> DataFrame:
    """Pickup strictly before dropoff, equal, after, or not comparable."""
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(pickup < dropoff).alias("n_before"),
        F.count_if(pickup == dropoff).alias("n_equal"),
        F.count_if(pickup > dropoff).alias("n_after"),
        F.count_if(pickup.isNull() | dropoff.isNull()).alias("n_unknown"),
    )


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows checked and failed per rule. Rules overlap, so counts do too."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n_checked"),
        *(
            F.expr(f"count_if({rule.failed}) AS failed_{rule.name}") for rule in rules
        ),
    )
    return to_rows(
        wide,
        [
            {
                "rule": F.lit(rule.name),
                "n_checked": F.col("n_checked"),
                "n_failed": F.col(f"failed_{rule.name}"),
                "failed_rate": rate(F.col(f"failed_{rule.name}"), F.col("n_checked")),
            }
            for rule in rules
        ],
    )


def reject_reasons(df: DataFrame, rules: Sequence[Rule], *keys: str) -> DataFrame:
    """Rejected rows per exact combination of failed rules.

    The counts of all combinations add up to the rows dropped, each row once.
    Rows are grouped by number; names are put in once per combination.
    """
    combinations = (
        df.select(*keys, failed_mask(rules).alias("mask"))
        .filter("mask <> 0")
        .groupBy(*keys, "mask")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    names = F.array_join(rule_names("mask", rules), "+").alias("reasons")
    return combinations.select(*keys, names, "n_rows")


def _text(name: str, kind: T.DataType) -> Column:
    """A value as text that other engines write alike: whole numbers and strings.

    Fractions count in millionths, times in microseconds. The name stands before
    it, and alone for a null.
    """
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = F.round(value * 1_000_000).cast("decimal(38,0)").cast("string")
        text = F.when(F.isnan(value) | (F.abs(value) > 1e30), value.cast("string")).otherwise(whole)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.unix_micros(value.cast("timestamp")).cast("string")
    else:
        text = value.cast("string")
    return F.coalesce(F.concat(F.lit(f"{name}="), text), F.lit(name))


def row_hash(df: DataFrame) -> Column:
    """A whole number for a row, whatever the order of its columns."""
    fields = sorted(df.schema, key=lambda f: f.name)
    row = F.concat_ws("|", *(_text(f.name, f.dataType) for f in fields))
    return F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def checksum(df: DataFrame, *keys: str) -> DataFrame:
    """Checksum of the rows per key, the same for every order of rows and columns."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_hash(df)).cast("decimal(38,0)").cast("string").alias("checksum"),
    )
