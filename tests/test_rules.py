"""Row rules and derived columns at their boundaries."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fareloom.contract import BOUNDS, Bound
from fareloom.functions import bands, calendar
from fareloom.labels import ENGLISH, PORTUGUESE, LabelSet
from fareloom.operators import quality
from fareloom.operators.derive import add_time_columns
from fareloom.plans.medallion import Layers

NOON = dt.datetime(2024, 5, 6, 12)
TRIP = {
    "id": 0,
    "total_amount": 10.0,
    "passenger_count": 1.0,
    "tpep_pickup_datetime": NOON,
    "tpep_dropoff_datetime": NOON + dt.timedelta(minutes=10),
    "trip_distance": 2.0,
    "trip_duration_minutes": 10.0,
}
TYPES = (
    "id int, total_amount double, passenger_count double, tpep_pickup_datetime timestamp_ntz, "
    "tpep_dropoff_datetime timestamp_ntz, trip_distance double, trip_duration_minutes double"
)


def trips(spark, *changes):
    rows = [{**TRIP, "id": i, **change} for i, change in enumerate(changes)]
    names = [column.split()[0] for column in TYPES.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], TYPES)


def kept_ids(frame, rules):
    return {row["id"] for row in quality.keep_rows(frame, rules).collect()}


def rule(name):
    every = quality.bronze_rules() + quality.silver_rules()
    return [r for r in every if r.name == name]


CASES = [
    ("non_negative", "total_amount", [0.0, 0.01, math.nan], [-0.01, None]),
    ("passenger_range", "passenger_count", [None, 0.0, 10.0], [-1.0, 10.5, 11.0]),
    ("amount_cap", "total_amount", [1000.0], [1000.01, math.nan]),
    (
        "duration_range",
        "trip_duration_minutes",
        [1.0, 1440.0],
        [59 / 60, 1440 + 1 / 60, 0.0, None],
    ),
    ("distance_cap", "trip_distance", [None, 100.0, -5.0], [100.1]),
    ("not_null", "total_amount", [0.0], [None]),
    ("not_null", "tpep_pickup_datetime", [NOON], [None]),
    ("not_null", "tpep_dropoff_datetime", [NOON], [None]),
    ("time_order", "tpep_dropoff_datetime", [NOON], [NOON - dt.timedelta(seconds=1)]),
]


@pytest.mark.parametrize("name,column,keep,reject", CASES)
def test_rule_boundaries(spark, name, column, keep, reject):
    frame = trips(spark, *({column: value} for value in keep + reject))
    assert kept_ids(frame, rule(name)) == set(range(len(keep)))


def test_rejected_rows_are_the_complement(spark):
    frame = trips(
        spark,
        {},
        {"total_amount": None},
        {"total_amount": -1.0, "trip_distance": 101.0},
        {"passenger_count": None},
        {"total_amount": math.nan},
    )
    rules = quality.bronze_rules() + quality.silver_rules()
    rejected = {r["id"]: r["reasons"] for r in quality.rejected_rows(frame, rules).collect()}
    assert set(rejected) | kept_ids(frame, rules) == set(range(5))
    assert not set(rejected) & kept_ids(frame, rules)
    assert rejected[1] == ["not_null", "non_negative", "amount_cap"]
    assert rejected[2] == ["non_negative", "distance_cap"]
    assert rejected[4] == ["amount_cap"]


def test_nan_passes_bronze_and_fails_silver(spark):
    frame = trips(spark, {"total_amount": math.nan})
    assert kept_ids(frame, quality.bronze_rules()) == {0}
    assert kept_ids(frame, quality.silver_rules()) == set()


def test_cleaning_twice_changes_nothing(spark, sf_dir):
    from fareloom.plans import registry

    once = quality.keep_rows(registry.trips(spark, sf_dir), quality.bronze_rules())
    assert quality.keep_rows(once, quality.bronze_rules()).count() == once.count()


def test_bounds_are_parameters(spark):
    frame = trips(spark, {"total_amount": 1500.0}).drop("trip_duration_minutes")
    frame = frame.withColumn("taxi_type", F.lit("yellow"))
    assert Layers().silver(Layers().bronze(frame)).count() == 0
    wider = Layers(bounds={"total_amount": Bound(0, 2000)})
    assert wider.silver(wider.bronze(frame)).count() == 1
    assert BOUNDS["total_amount"].high == 1000


def test_silver_without_distance_column(spark):
    frame = trips(spark, {}).drop("trip_distance", "trip_duration_minutes")
    assert Layers().silver(Layers().bronze(frame)).count() == 1


def values(spark, expression, kind, inputs):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    rows = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


def test_day_name(spark):
    names = values(spark, lambda c: calendar.day_name(c, PORTUGUESE), "int", [1, 4, 7, 8, None])
    assert names == ["Domingo", "Quarta", "Sábado", None, None]


def test_day_period(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    small, morning, afternoon, evening = PORTUGUESE.periods
    assert values(spark, lambda c: calendar.day_period(c, PORTUGUESE), "int", hours) == [
        *[small] * 2,
        *[morning] * 2,
        *[afternoon] * 2,
        *[evening] * 2,
        small,
    ]


def test_weekday_numbers(spark):
    days = [dt.datetime(2023, 5, 7), dt.datetime(2023, 5, 6), dt.datetime(2023, 5, 8)]
    assert values(spark, F.dayofweek, "timestamp_ntz", days) == [1, 7, 2]
    assert values(spark, calendar.is_weekend, "int", [1, 7, 2]) == [True, True, False]


def test_duration_counts_whole_seconds(spark):
    start = dt.datetime(2024, 3, 10, 0, 0, 0, 100_000)
    end = dt.datetime(2024, 3, 10, 0, 1, 30, 900_000)
    frame = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    assert frame.select(calendar.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1.5


def test_duration_ignores_daylight_saving(spark):
    before, after = dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30)
    frame = spark.createDataFrame([(before, after)], "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert frame.select(calendar.minutes_between(F.col("a"), F.col("b"))).first()[0] == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_fare_band(spark):
    low, mid, high, top = PORTUGUESE.fare_bands
    amounts = [10.0, 10.01, 25.0, 25.01, 50.0, 50.01, None, math.nan]
    assert values(spark, lambda c: bands.fare_band(c, PORTUGUESE), "double", amounts) == [
        low, mid, mid, high, high, top, top, top,
    ]


def test_party_size(spark):
    one, two, few, many = PORTUGUESE.party_sizes
    counts = [1.0, 2.0, 3.0, 4.0, 5.0, 2.5, None]
    assert values(spark, lambda c: bands.party_size(c, PORTUGUESE), "double", counts) == [
        one, two, few, few, many, many, many,
    ]


def test_demand_band(spark):
    hours = [6, 7, 9, 10, 17, 19, 20, 22, 23, 0]
    morning, evening, night, normal = ENGLISH.demand
    assert values(spark, lambda c: bands.demand_band(c, ENGLISH), "int", hours) == [
        normal, morning, morning, normal, evening, evening, normal, night, night, normal,
    ]


def test_at_least_one(spark):
    assert values(spark, bands.at_least_one, "double", [None, 0.0, 3.0]) == [1.0, 1.0, 3.0]


def test_year_month(spark):
    frame = spark.createDataFrame([(2024, 5), (2024, 10), (None, 1)], "y int, m int")
    texts = frame.select(calendar.year_month(F.col("y"), F.col("m")).alias("t")).collect()
    assert [row["t"] for row in texts] == ["2024-05", "2024-10", None]


def test_labels_must_be_distinct():
    with pytest.raises(ValueError, match="distinct"):
        LabelSet(
            weekdays=("a",) * 7,
            periods=ENGLISH.periods,
            fare_bands=ENGLISH.fare_bands,
            party_sizes=ENGLISH.party_sizes,
            demand=ENGLISH.demand,
            day_types=ENGLISH.day_types,
            indicators=ENGLISH.indicators,
            titles={},
        )


def test_label_language(spark):
    frame = add_time_columns(trips(spark, {}), ENGLISH)
    row = frame.first()
    assert (row["pickup_dayname"], row["pickup_period"]) == ("Monday", "Afternoon")
