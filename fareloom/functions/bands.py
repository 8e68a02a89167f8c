"""Expressions that sort a value into a labelled band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.labels import LabelSet

FARE_EDGES = (10, 25, 50)  # fixed values: upper edges, included

# First and last hour of the morning, evening and night peak.
DEMAND_HOURS = ((7, 9), (17, 19), (22, 23))


def first_match(conditions, texts) -> Column:
    """Text of the first true condition, else the one text left over."""
    *matched, rest = texts
    pairs = zip(conditions, matched, strict=True)
    chain = F.when(*next(pairs))
    for condition, text in pairs:
        chain = chain.when(condition, text)
    return chain.otherwise(rest)


def fare_band(amount: Column, labels: LabelSet) -> Column:
    """Price band; null and NaN fall into the top band."""
    return first_match((amount <= edge for edge in FARE_EDGES), labels.fare_bands)


def party_size(passengers: Column, labels: LabelSet) -> Column:
    """One, two, three to four, or group (also for fractions and null)."""
    return first_match(
        (passengers == 1, passengers == 2, passengers.between(3, 4)), labels.party_sizes
    )


def demand_band(hour: Column, labels: LabelSet) -> Column:
    return first_match((hour.between(*span) for span in DEMAND_HOURS), labels.demand)


def day_type(weekend: Column, labels: LabelSet) -> Column:
    weekday_text, weekend_text = labels.day_types
    return F.when(weekend, weekend_text).otherwise(weekday_text)


def at_least_one(passengers: Column) -> Column:
    """Passenger count with null and zero read as one."""
    return F.when(passengers.isNull() | (passengers == 0), F.lit(1.0)).otherwise(passengers)
