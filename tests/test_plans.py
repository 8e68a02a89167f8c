"""The physical plans: what is pushed down, pruned, shuffled and left out."""

import pytest
from pyspark.sql import functions as F

from fareloom.contract import PARTITIONING
from fareloom.plans import answers, registry
from fareloom.plans.medallion import Layers, unify_mixed
from fareloom.sources import landing


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    entries = landing.landing_entries(spark, registry.plain_folder(spark, sf_dir))
    return landing.ingest(spark, entries).raw


def test_drifting_files_are_one_more_scan_per_fleet(spark, sf_dir):
    text = plan(Layers().bronze(unify_mixed(registry.ingested(spark, sf_dir).raw)))
    assert text.count("FileScan") == 4
    assert text.count("GreaterThanOrEqual(total_amount,0.0)") == 3  # text cannot be compared


def test_bronze_rules_reach_the_file_scan(raw):
    text = plan(Layers().silver(Layers().bronze(unify_mixed(raw))))
    assert text.count("FileScan") == 2  # one per fleet
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(total_amount)" in pushed
    assert "GreaterThanOrEqual(total_amount,0.0)" in text
    assert "LessThanOrEqual(total_amount,1000.0)" in text


def test_fleet_and_month_drop_whole_files(raw):
    bronze = Layers().bronze(unify_mixed(raw))
    assert plan(bronze.filter("taxi_type = 'yellow'")).count("FileScan") == 1
    one = bronze.filter("taxi_type = 'yellow' AND year_month = '2024-05'")
    assert plan(one).count("FileScan") == 1
    wanted = {f"yellow_tripdata_2024-05{landing.SUFFIX}"}
    assert {row[0] for row in one.select("source_file").distinct().collect()} <= wanted


def test_rollup_reads_only_what_it_needs(raw):
    text = plan(Layers().gold_from(unify_mixed(raw)))
    for schema in text.split("ReadSchema: ")[1:]:
        assert "fare_amount" not in schema.split("\n")[0]
        assert "VendorID" not in schema.split("\n")[0]


def test_rollup_shuffles_once(spark, sf_dir):
    text = plan(registry.gold(spark, sf_dir))
    assert text.count("Exchange") == 1
    assert "partial_count(1)" in text


def test_rollup_groups_on_the_cell_key_only(spark, sf_dir):
    exchange = next(
        line for line in plan(registry.gold(spark, sf_dir)).splitlines() if "Exchange" in line
    )
    assert "pickup_dayname" not in exchange and "pickup_period" not in exchange


@pytest.mark.parametrize("name", ["q1_main", "exec_summary", "q1_share", "weekend_split"])
def test_answers_scan_once(spark, sf_dir, name):
    text = plan(registry.all_queries()[name](spark, sf_dir))
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["top5_hours", "q2_top3", "peak_hour", "explore_gold"])
def test_limits_do_not_sort_everything(spark, sf_dir, name):
    text = plan(registry.all_queries()[name](spark, sf_dir))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_no_python_and_no_cross_join(spark, sf_dir):
    for name in ("gold_rollup", "dq_report", "dq_distribution", "exec_summary", "q2_period"):
        text = plan(registry.all_queries()[name](spark, sf_dir))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)


def test_fleet_filter_prunes_table_partitions(spark, sf_dir):
    lake = registry.layer_tables(spark, sf_dir)
    text = plan(answers.of_fleet(Layers().gold(lake.read("silver")), "yellow"))
    assert "taxi_type" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_silver_is_written_without_a_shuffle(spark, sf_dir):
    lake = registry.layer_tables(spark, sf_dir)
    assert "Exchange" not in plan(Layers().silver(lake.read("bronze")))


def test_month_filter_on_bronze_prunes(spark, sf_dir):
    lake = registry.layer_tables(spark, sf_dir)
    text = plan(lake.read("bronze").filter((F.col("pickup_year") == 2024) & (F.col("pickup_month") == 5)))
    assert all(key in text.split("PartitionFilters: [")[1].split("]")[0] for key in PARTITIONING[1:])


def test_listing_reads_no_content(spark, sf_dir):
    files = landing.list_files(spark, registry.landing_folder(spark, sf_dir))
    schema = plan(files).split("ReadSchema: ")[1].split("\n")[0]
    assert "content" not in schema
