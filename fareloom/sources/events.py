"""Trip-shaped views over the `events` and `lineitem` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.contract import (
    AMOUNT,
    DISTANCE,
    DROPOFF,
    FLEET,
    GREEN,
    PASSENGERS,
    PICKUP,
    VENDOR,
    YELLOW,
    Fleet,
)
from fareloom.functions.calendar import year_month

# Events that stand for trips of the first fleet; all others, of whatever type or
# none, are the second one's.
FIRST_FLEET_EVENTS = ("view", "click", "purchase")


def _fleet() -> Column:
    first = F.col("event_type").isin(*FIRST_FLEET_EVENTS)
    return F.when(first, YELLOW.name).otherwise(GREEN.name)


# Trip columns of one event, with gaps and outliers in them.
PICKUP_SQL = "ts + (event_id % 5) * INTERVAL '30' DAY"
RENAMED = {VENDOR: "user_id", PICKUP: "pickup", "fare_amount": "value"}
COMPUTED = {
    PASSENGERS: "IF(event_id % 17 = 0, NULL, CAST((event_id * 7) % 13 AS DOUBLE))",
    AMOUNT: (
        "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN -value "
        "WHEN event_id % 31 = 0 THEN value * 20 ELSE value END"
    ),
    DROPOFF: (
        "IF(event_id % 37 = 0, NULL, "
        "pickup + ((event_id * 7919) % 1500 - 30) * INTERVAL '1' MINUTE)"
    ),
    DISTANCE: "IF(event_id % 19 = 0, NULL, CAST((event_id * 31) % 1100 AS DOUBLE) / 10)",
}


def shape(events: DataFrame, fleet: Fleet) -> DataFrame:
    """Trip columns of each event under the fleet's own names.

    They come out of one-row generators. A plain projection would be copied
    into every rule and every derived column that refers to it, and the time
    arithmetic be done a dozen times per trip instead of once.
    """
    kept = [name for name in events.columns if name in ("event_id", FLEET)]
    names = dict(zip((*RENAMED, *COMPUTED), fleet.native((*RENAMED, *COMPUTED)), strict=True))
    renamed = [f"{source} AS {names[name]}" for name, source in RENAMED.items()]
    computed = ", ".join(names[name] for name in COMPUTED)
    return events.selectExpr("*", f"stack(1, {PICKUP_SQL}) AS (pickup)").selectExpr(
        *kept, *renamed, f"stack(1, {', '.join(COMPUTED.values())}) AS ({computed})"
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def fleet_frame(spark: SparkSession, sf_dir: str, fleet: Fleet) -> DataFrame:
    """One fleet's trips under the fleet's own column names."""
    return shape(read_events(spark, sf_dir).filter(_fleet() == fleet.name), fleet)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips under canonical names, in one scan, with provenance columns."""
    events = read_events(spark, sf_dir)
    month = year_month(F.year(PICKUP), F.month(PICKUP))
    return shape(events.withColumn(FLEET, _fleet()), YELLOW).withColumns(
        {
            "year_month": month,
            "source_file": F.concat(F.col(FLEET), F.lit("_tripdata_"), month, F.lit(".parquet")),
            "ingestion_timestamp": F.current_timestamp(),
        }
    )


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines under canonical trip names: shipping day as pickup, quantity
    as minutes and, twentyfold, as amount; one fleet per return flag."""
    dropoff = "l_shipdate + CAST(l_quantity AS BIGINT) * INTERVAL '1' MINUTE"
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        f"l_suppkey AS {VENDOR}",
        f"CAST(l_linenumber AS DOUBLE) AS {PASSENGERS}",
        f"l_quantity * 20 AS {AMOUNT}",
        f"l_shipdate AS {PICKUP}",
        f"l_returnflag AS {FLEET}",
        f"stack(1, {dropoff}) AS ({DROPOFF})",
    )
