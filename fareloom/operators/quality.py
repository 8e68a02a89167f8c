"""Row rules: which trips a layer keeps, and why it drops the others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.contract import (
    AMOUNT,
    BOUNDS,
    DISTANCE,
    DROPOFF,
    DURATION,
    DURATION_BOUND,
    PASSENGERS,
    PICKUP,
    Bound,
)
from fareloom.functions.calendar import minutes_between


@dataclass(frozen=True)
class Rule:
    """A named condition for keeping a row, as SQL. Null counts as not met."""

    name: str
    sql: str

    @property
    def failed(self) -> str:
        return f"NOT coalesce({self.sql}, false)"


def filled(name: str, *columns: str) -> Rule:
    return Rule(name, " AND ".join(f"{column} IS NOT NULL" for column in columns))


def within(name: str, column: str, bound: Bound) -> Rule:
    return Rule(name, f"{column} BETWEEN {bound.low} AND {bound.high}")


def or_null(rule: Rule, column: str) -> Rule:
    """The same rule, met by a null in `column` too."""
    return Rule(rule.name, f"{column} IS NULL OR ({rule.sql})")


def bronze_rules(bounds: Mapping[str, Bound] = BOUNDS) -> list[Rule]:
    return [
        filled("not_null", PICKUP, DROPOFF, AMOUNT),
        Rule("non_negative", f"{AMOUNT} >= {bounds[AMOUNT].low}"),
        Rule("time_order", f"{PICKUP} <= {DROPOFF}"),
        or_null(within("passenger_range", PASSENGERS, bounds[PASSENGERS]), PASSENGERS),
    ]


def silver_rules(
    bounds: Mapping[str, Bound] = BOUNDS, minutes: Bound = DURATION_BOUND
) -> list[Rule]:
    return [
        Rule("amount_cap", f"{AMOUNT} <= {bounds[AMOUNT].high}"),
        within("duration_range", DURATION, minutes),
        or_null(Rule("distance_cap", f"{DISTANCE} <= {bounds[DISTANCE].high}"), DISTANCE),
    ]


def declared_rules(bounds: Mapping[str, Bound] = BOUNDS) -> list[Rule]:
    """The declared bounds, each as one rule that a null meets."""
    return [
        or_null(within(f"{column}_bounds", column, bound), column)
        for column, bound in bounds.items()
    ]


def applicable(rules: Sequence[Rule], df: DataFrame) -> list[Rule]:
    """Leave out the distance rule where the source has no distance column."""
    present = {name.lower() for name in df.columns}
    return [rule for rule in rules if rule.name != "distance_cap" or DISTANCE in present]


def keep_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule: one conjunctive filter, pushed to the scan."""
    return df.filter(" AND ".join(f"({rule.sql})" for rule in rules))


def failed_mask(rules: Sequence[Rule]) -> Column:
    """The rules a row fails as bits of a number, the first rule lowest."""
    bits = (f"IF({rule.failed}, {1 << i}L, 0L)" for i, rule in enumerate(rules))
    return F.expr(" + ".join(bits))


def rule_names(mask: str, rules: Sequence[Rule]) -> Column:
    """The names behind such a number, as an array."""
    names = (f"IF({mask} & {1 << i}L <> 0, '{r.name}', NULL)" for i, r in enumerate(rules))
    return F.expr(f"array_compact(array({', '.join(names)}))")


REASONS = "reject_reasons"


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows, with the names of the rules each fails; null for a row that meets all."""
    # Out of a one-row generator: a plain projection would be worked out again for
    # every reference to it.
    judged = df.select("*", F.inline(F.array(F.struct(failed_mask(rules).alias("__mask")))))
    reasons = F.when(F.col("__mask") != 0, rule_names("__mask", rules))
    return judged.withColumn(REASONS, reasons).drop("__mask")


def rejected_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The other side of `keep_rows`, with the reasons of each rejected row."""
    rejected = df.withColumn("mask", failed_mask(rules)).filter("mask <> 0")
    return rejected.withColumn("reasons", rule_names("mask", rules)).drop("mask")


def with_duration(df: DataFrame) -> DataFrame:
    """Add the duration column where the frame has none yet."""
    if DURATION in df.columns:
        return df
    return df.withColumn(DURATION, minutes_between(F.col(PICKUP), F.col(DROPOFF)))
