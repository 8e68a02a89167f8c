"""Derived columns of the bronze and silver layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import AMOUNT, DROPOFF, DURATION, PASSENGERS, PICKUP, WEEKDAY
from fareloom.functions import bands, calendar
from fareloom.labels import PORTUGUESE, LabelSet


def add_time_columns(df: DataFrame, labels: LabelSet = PORTUGUESE) -> DataFrame:
    """Pickup date parts, weekday name, period of day and duration."""
    parts = calendar.date_parts(F.col(PICKUP))
    return df.withColumns(
        {
            **parts,
            "pickup_dayname": calendar.day_name(F.dayofweek(PICKUP), labels),
            "pickup_period": calendar.day_period(F.hour(PICKUP), labels),
            DURATION: calendar.minutes_between(F.col(PICKUP), F.col(DROPOFF)),
        }
    )


def impute_passengers(df: DataFrame) -> DataFrame:
    return df.withColumn(PASSENGERS, bands.at_least_one(F.col(PASSENGERS)))


def add_categories(df: DataFrame, labels: LabelSet = PORTUGUESE) -> DataFrame:
    """Weekend flag, fare band and party size."""
    return df.withColumns(
        {
            "is_weekend": calendar.is_weekend(F.col(WEEKDAY)),
            "fare_category": bands.fare_band(F.col(AMOUNT), labels),
            "passenger_category": bands.party_size(F.col(PASSENGERS), labels),
        }
    )
