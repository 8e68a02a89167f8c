"""Expressions over pickup and dropoff time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.contract import HOUR, MONTH, WEEKDAY, YEAR
from fareloom.functions.bands import first_match
from fareloom.labels import LabelSet


def date_parts(ts: Column) -> dict[str, Column]:
    """Year, month, hour and weekday (1 = Sunday) of a timestamp."""
    return {YEAR: F.year(ts), MONTH: F.month(ts), HOUR: F.hour(ts), WEEKDAY: F.dayofweek(ts)}


def day_name(weekday: Column, labels: LabelSet) -> Column:
    """Weekday text; null for null or for a number outside 1 to 7."""
    return F.get(F.array(*map(F.lit, labels.weekdays)), weekday - 1)


def day_period(hour: Column, labels: LabelSet) -> Column:
    """Quarter of the day; a null hour counts as small hours."""
    small_hours, *daytime = labels.periods
    quarters = (hour.between(first, first + 5) for first in (6, 12, 18))
    return first_match(quarters, (*daytime, small_hours))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, each cut to whole seconds first.

    unix_timestamp takes zoned and zoneless timestamps, and reads the zoneless
    ones without the session time zone, so daylight saving cannot shift it.
    """
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def is_weekend(weekday: Column) -> Column:
    return weekday.isin(1, 7)


def year_month(year: Column, month: Column) -> Column:
    """`yyyy-MM` text."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
