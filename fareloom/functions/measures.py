"""Aggregate expressions over the hourly rollup, and number texts."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def trips() -> Column:
    return F.sum("total_trips")


def revenue() -> Column:
    return F.round(F.sum("sum_total_amount"), 2)


def mean_fare() -> Column:
    """Mean amount per trip, weighted by the trips of each cell."""
    return F.round(F.try_divide(F.sum("sum_total_amount"), F.sum("total_trips")), 2)


def mean_passengers() -> Column:
    return F.round(F.try_divide(F.sum("sum_passenger_count"), F.sum("total_trips")), 2)


def ratio_where(condition: Column, numerator: str, denominator: str) -> Column:
    """Sum over sum of the rows that meet a condition; null if none does."""
    return F.try_divide(
        F.sum(F.when(condition, F.col(numerator)).otherwise(0)),
        F.sum(F.when(condition, F.col(denominator)).otherwise(0)),
    )


def share_of_total(count: str) -> Column:
    """Percentage of a column's total over all result rows.

    The window has one partition. Use it on grouped results only, whose size
    the number of hours, months, fleets or labels bounds.
    """
    total = F.sum(count).over(Window.partitionBy())
    return F.round(F.try_divide(F.col(count) * F.lit(100.0), total), 2)


def count_text(value: Column) -> Column:
    return F.format_number(value, 0)


def decimal_text(value: Column) -> Column:
    return F.format_number(value, 2)


def money_text(value: Column) -> Column:
    return F.concat(F.lit("$"), decimal_text(value))
