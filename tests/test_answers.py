"""Invariants of the rollup and the answers, and their edge cases."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from fareloom.labels import ENGLISH, PORTUGUESE
from fareloom.operators.distribution import distribution, in_ranges, value_counts
from fareloom.operators.profile import checksum
from fareloom.operators.rollup import GOLD_COLUMNS
from fareloom.plans import answers, registry


@pytest.fixture(scope="module")
def gold(spark, sf_dir):
    frame = registry.gold(spark, sf_dir).cache()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    frame = registry.silver(spark, sf_dir).cache()
    yield frame
    frame.unpersist()


def test_rollup_adds_up(gold, silver):
    cells = gold.agg(F.sum("total_trips"), F.sum("sum_total_amount"), F.sum("sum_passenger_count"))
    rows = silver.agg(F.count(F.lit(1)), F.sum("total_amount"), F.sum("passenger_count"))
    assert tuple(cells.first()) == pytest.approx(tuple(rows.first()))
    assert tuple(gold.columns) == GOLD_COLUMNS


def test_mean_lies_between_extremes(gold):
    outside = gold.filter(
        (F.col("avg_total_amount") < F.col("min_total_amount") - 1e-9)
        | (F.col("avg_total_amount") > F.col("max_total_amount") + 1e-9)
    )
    assert outside.count() == 0


@pytest.mark.parametrize(
    "name,share",
    [
        ("q1_share", "percentage_trips_month"),
        ("q2_period", "percentage_trips"),
        ("fleet_compare", "percentage_market"),
        ("weekend_split", "percentage_trips"),
    ],
)
def test_shares_add_up_to_hundred(gold, name, share):
    report = answers.catalogue(registry.PERIOD)[name](gold)
    assert report.agg(F.sum(share)).first()[0] == pytest.approx(100, abs=0.05)


def test_shares_of_top_hours_refer_to_all_hours(gold):
    total = gold.agg(F.sum("total_trips")).first()[0]
    for row in answers.busiest_hours(gold).collect():
        assert row["percentage_trips"] == pytest.approx(100 * row["total_trips"] / total, abs=0.01)


def test_no_trips_gives_nulls_not_errors(gold):
    none = gold.filter("taxi_type = 'none'")
    assert answers.fleet_mean(none).first()["avg_total_amount"] is None
    texts = {r["indicator"]: r["result"] for r in answers.executive_summary(none).collect()}
    assert set(texts.values()) == {None}
    assert answers.weekend_fare_gap(none).count() == 0
    assert answers.peak(none, "taxi_type").count() == 0


def test_fare_gap_needs_both_sides(gold):
    assert answers.weekend_fare_gap(gold.filter("is_weekend")).count() == 0


def test_fare_gap_direction(gold):
    factor = F.when(F.col("is_weekend"), 1).otherwise(5)
    dearer = gold.withColumn("sum_total_amount", F.col("sum_total_amount") * factor)
    row = answers.weekend_fare_gap(dearer).first()
    assert row["dearer_side"] == "Weekday"
    assert row["gap_pct"] > 100


def test_summary_month_with_and_without_year(gold):
    other_year = gold.withColumns(
        {"pickup_year": F.lit(2023), "sum_passenger_count": F.col("sum_passenger_count") * 2}
    )
    both = gold.unionByName(other_year)
    one = answers.final_metrics(both, month=5, year=2024).first()["answer_2"]
    every = answers.final_metrics(both, month=5).first()["answer_2"]
    assert one == answers.final_metrics(gold, month=5).first()["answer_2"]
    assert every == pytest.approx(1.5 * one, abs=0.02)


def test_language_of_answers(gold):
    rows = answers.weekend_split(gold, PORTUGUESE).collect()
    assert {r["day_type"] for r in rows} == {"Dia Útil", "Fim de Semana"}
    indicators = [r["indicator"] for r in answers.executive_summary(gold, labels=PORTUGUESE).collect()]
    assert indicators == list(PORTUGUESE.indicators)
    assert answers.answer(gold, "q1_main", registry.PERIOD, PORTUGUESE).first()[0].startswith("PERG")


def test_number_texts(spark):
    from fareloom.functions.measures import count_text, money_text

    frame = spark.createDataFrame([(1234567, 1234.125)], "n bigint, x double")
    row = frame.select(count_text(F.col("n")), money_text(F.col("x"))).first()
    assert tuple(row) == ("1,234,567", "$1,234.12")


def test_views(spark, gold):
    names = answers.register_views(spark, gold, registry.PERIOD)
    assert spark.sql("SELECT avg_total_amount FROM answer_q1_main").first()[0] == 57.57
    assert len(names) == len(answers.catalogue(registry.PERIOD))
    for name in names:
        spark.catalog.dropTempView(name)


def test_equal_hours_come_in_order_of_the_hour(gold):
    flat = gold.groupBy("pickup_hour").agg(F.lit(1).cast("bigint").alias("total_trips"))
    top = answers.top_rows(flat, "total_trips", "pickup_hour", 3).collect()
    assert [r["pickup_hour"] for r in top] == [0, 1, 2]


def test_every_title_names_an_answer():
    assert set(ENGLISH.titles) <= set(answers.catalogue(registry.PERIOD))


def test_checksum_ignores_order_and_sees_changes(spark, silver):
    trips = silver.drop("ingestion_timestamp")
    one = sorted(checksum(trips, "taxi_type").collect())
    assert sorted(checksum(trips.orderBy(F.desc("event_id")), "taxi_type").collect()) == one
    changed = trips.withColumn(
        "total_amount", F.col("total_amount") + F.when(F.col("event_id") == 1, 0.01).otherwise(0)
    )
    first = trips.filter("event_id = 1").count()
    assert (sorted(checksum(changed, "taxi_type").collect()) != one) == bool(first)


def exact(values, per_mille):
    ordered = sorted(values)
    rank = max(1, math.ceil(len(ordered) * per_mille / 1000))
    return ordered[rank - 1]


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [0.0] * 500 + [1.0],
        [float(v) for v in range(-300, 300)],
        [7.25] * 400 + [float(v % 97) - 40 for v in range(800)],
        [1e-9, 1e9, -1e9, 3.5, 3.5, 3.5, 1e300],
    ],
)
def test_quantiles_against_brute_force(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    row = distribution(frame, ["v"], (1, 250, 500, 999, 1000)).first()
    assert row["n_values"] == len(values)
    for p in (1, 250, 500, 999, 1000):
        assert row[f"p{p}"] == exact(values, p)


def test_deviation_of_large_values(spark):
    """Squares of a thousand million have no digits left for the differences."""
    frame = spark.range(200).selectExpr("1e9 + id % 2 AS v", "(id % 37) / 1000 AS small")
    rows = {r["metric"]: r for r in distribution(frame, ["v", "small"]).collect()}
    assert rows["v"]["stddev_value"] == pytest.approx(0.5012547, abs=1e-6)
    small = [(i % 37) / 1000 for i in range(200)]
    for p in (250, 500, 750, 950):
        assert rows["small"][f"p{p}"] == exact(small, p)


def test_distribution_of_line_prices(spark, sf_dir):
    """Nearly all values differ, and no task has them all."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = distribution(lines, ["l_extendedprice"]).first()
    sql = "SELECT {} FROM read_parquet(?)".format(
        ", ".join(f"quantile_disc(l_extendedprice, {p / 1000})" for p in (250, 500, 750, 950))
        + ", stddev_samp(l_extendedprice)"
    )
    expected = duckdb.connect().execute(sql, [f"{sf_dir}/lineitem.parquet"]).fetchall()[0]
    assert tuple(row[f"p{p}"] for p in (250, 500, 750, 950)) == expected[:4]
    assert row["stddev_value"] == pytest.approx(expected[4])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = in_ranges(value_counts(lines, ["l_extendedprice"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.4 * sum(sizes)


def test_checksum_sees_where_nulls_are(spark):
    kind = "a int, b int, k int"
    one, other = (
        checksum(spark.createDataFrame(rows, kind), "k").first()["checksum"]
        for rows in ([(1, None, 0)], [(None, 1, 0)])
    )
    assert one != other
