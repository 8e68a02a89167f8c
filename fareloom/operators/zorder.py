"""Z-order: one sort key that keeps rows together which are near in several columns.

Every column is ranked among bounds that cut its values into equal shares, and
the ranks' bits are interleaved, the columns' highest bits first. Files of rows
in this order hold a small range of each column, so a filter on any one of them
skips most files; an order by one column after the other serves the first only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8  # of each column's rank
_BYTES = 6  # of a text that its rank looks at


def as_number(df: DataFrame, name: str) -> Column:
    """A column's values as doubles in the same order."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.substring(value.cast("binary"), 1, _BYTES), _BYTES, F.lit(b"\0"))
        return F.conv(F.hex(head), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double")


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Distinct bounds that cut each column's values in about equal shares, from one pass.

    The driver gets fewer than two to the power of `bits` numbers per column.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = df.select(*(as_number(df, name).alias(str(i)) for i, name in enumerate(columns)))
    positions = [str(i) for i in range(len(columns))]
    cuts = numbers.approxQuantile(positions, shares, 0.25 / (1 << bits))
    return {name: sorted(set(cut)) for name, cut in zip(columns, cuts, strict=True)}


def rank(value: Column, bounds: Sequence[float], bits: int = BITS) -> Column:
    """How many bounds a value reaches, by halving; 0 for a null."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(bits))))
    cuts = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>")

    def halve(at: Column, step: Column) -> Column:
        return F.when(value >= F.get(cuts, at + step - 1), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def z_value(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, as bigint."""
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, one in enumerate(ranks):
            single = F.shiftright(one, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total.bitwiseOR(F.shiftleft(single, bit * len(ranks) + len(ranks) - 1 - i))
    return total


def with_z(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS) -> DataFrame:
    """Add the z-value of some columns; at most 63 bits in all."""
    bits = min(bits, 63 // len(columns))
    bounds = rank_bounds(df, columns, bits)
    ranks = [rank(as_number(df, c), bounds[c], bits).alias(f"r{i}") for i, c in enumerate(columns)]
    # Out of a one-row generator: each bit would work the rank out again.
    ranked = df.select("*", F.explode(F.array(F.struct(*ranks))).alias("__ranks"))
    parts = [F.col(f"__ranks.r{i}") for i in range(len(columns))]
    return ranked.withColumn(name, z_value(parts, bits)).drop("__ranks")
