"""Schema unification does not depend on order, names or drifting types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.contract import FLEETS, GREEN, REQUIRED, YELLOW
from fareloom.operators import unify
from fareloom.plans.medallion import Layers, unify_mixed
from fareloom.plans.medallion import unify as unify_fleets

T = dt.datetime(2024, 5, 6, 12)


def yellow(spark):
    return spark.createDataFrame(
        [(1, 2.0, 10.0, T, T)],
        "VendorID bigint, passenger_count double, total_amount double, "
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz",
    ).withColumn("taxi_type", F.lit("yellow"))


def green(spark):
    """Other column order, an integer count, no dropoff, a column of its own."""
    return spark.createDataFrame(
        [(20.0, T, 3, 7, "x")],
        "total_amount double, lpep_pickup_datetime timestamp_ntz, passenger_count bigint, "
        "VendorID int, ehail string",
    ).withColumn("taxi_type", F.lit("green"))


def content(frame):
    names = sorted(frame.columns)
    return sorted(map(str, (tuple(row[n] for n in names) for row in frame.collect())))


def test_union_does_not_depend_on_order(spark):
    one = unify_fleets({"yellow": yellow(spark), "green": green(spark)})
    two = unify_fleets({"green": green(spark), "yellow": yellow(spark)})
    assert content(one) == content(two)
    assert dict(one.dtypes)["passenger_count"] == "double"
    assert "ehail" not in one.columns


def test_missing_required_column_is_a_typed_null(spark):
    frame = unify.standardize(green(spark), GREEN)
    assert dict(frame.dtypes)["tpep_dropoff_datetime"] == "timestamp_ntz"
    assert frame.first()["tpep_dropoff_datetime"] is None


def test_optional_columns_stay_away_when_absent(spark):
    assert "tip_amount" not in unify.standardize(yellow(spark), YELLOW).columns
    with_tip = yellow(spark).withColumn("tip_amount", F.lit(1))
    assert dict(unify.standardize(with_tip, YELLOW).dtypes)["tip_amount"] == "double"


def test_zoned_timestamps_stay_zoned(spark):
    zoned = yellow(spark).withColumn("tpep_pickup_datetime", F.current_timestamp())
    assert dict(unify.standardize(zoned, YELLOW).dtypes)["tpep_pickup_datetime"] == "timestamp"


@pytest.mark.parametrize("first", ["yellow", "green"])
def test_mixed_table_keeps_all_rows_in_both_orders(spark, first):
    frames = {"yellow": yellow(spark), "green": green(spark)}
    second = "green" if first == "yellow" else "yellow"
    mixed = unify.union_all([frames[first], frames[second]])
    merged = unify_mixed(mixed)
    rows = {r["taxi_type"]: r["tpep_pickup_datetime"] for r in merged.collect()}
    assert rows == {"yellow": T, "green": T}
    assert "lpep_pickup_datetime" not in merged.columns


def test_mixed_table_of_one_fleet_only(spark):
    only_green = unify_mixed(green(spark))
    assert only_green.first()["tpep_pickup_datetime"] == T


def test_native_names():
    assert GREEN.native(REQUIRED)[3:] == ["lpep_pickup_datetime", "lpep_dropoff_datetime"]
    assert YELLOW.native(REQUIRED) == list(REQUIRED)


def test_contract_gaps(spark):
    assert unify.contract_gaps(green(spark).columns, GREEN) == ["lpep_dropoff_datetime"]
    assert unify.contract_gaps(["vendorid"], YELLOW)[0] == "passenger_count"


def test_column_names_ignore_case(spark):
    lower = yellow(spark).withColumnRenamed("VendorID", "vendorid")
    frame = unify.standardize(lower, YELLOW)
    assert "VendorID" in frame.columns
    assert frame.first()["VendorID"] == 1


def test_unknown_fleet_passes_under_its_own_name(spark):
    blue = yellow(spark).withColumn("taxi_type", F.lit("blue"))
    assert "blue" not in FLEETS
    gold = Layers().bronze(unify_fleets({"blue": blue}))
    assert {r["taxi_type"] for r in gold.collect()} == {"blue"}
