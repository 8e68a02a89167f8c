"""The hourly rollup: the gold layer every answer is computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import AMOUNT, CELL_KEY, DURATION, HOUR, MONTH, PASSENGERS, WEEKDAY, YEAR
from fareloom.functions import calendar
from fareloom.labels import PORTUGUESE, LabelSet

# Names of the gold table's columns, which SQL over it relies on.
GOLD_COLUMNS = (
    "taxi_type",
    "pickup_year",
    "pickup_month",
    "pickup_hour",
    "pickup_period",
    "pickup_dayname",
    "is_weekend",
    "total_trips",
    "avg_total_amount",
    "sum_total_amount",
    "avg_passenger_count",
    "sum_passenger_count",
    "avg_trip_duration",
    "min_total_amount",
    "max_total_amount",
    "year_month",
)


def hourly_rollup(silver: DataFrame, labels: LabelSet = PORTUGUESE) -> DataFrame:
    """Trips per fleet, month, hour and weekday, with their measures.

    The trips are grouped on the five columns that identify a cell. Labels,
    weekend flag and month text follow from these, so they are computed after
    the aggregation, once per cell. Each task sends at most one partial row per
    cell into the shuffle, however many trips a single cell holds.
    """
    cells = silver.groupBy(*CELL_KEY).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.avg(AMOUNT).alias("avg_total_amount"),
        F.sum(AMOUNT).alias("sum_total_amount"),
        F.avg(PASSENGERS).alias("avg_passenger_count"),
        F.sum(PASSENGERS).alias("sum_passenger_count"),
        F.avg(DURATION).alias("avg_trip_duration"),
        F.min(AMOUNT).alias("min_total_amount"),
        F.max(AMOUNT).alias("max_total_amount"),
    )
    return cells.withColumns(
        {
            "pickup_period": calendar.day_period(F.col(HOUR), labels),
            "pickup_dayname": calendar.day_name(F.col(WEEKDAY), labels),
            "is_weekend": calendar.is_weekend(F.col(WEEKDAY)),
            "year_month": calendar.year_month(F.col(YEAR), F.col(MONTH)),
        }
    ).select(*GOLD_COLUMNS)
