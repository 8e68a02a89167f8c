"""Layer tables: writes, partition overwrite, compaction, clustering, upkeep."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fareloom.contract import PARTITIONING
from fareloom.plans import registry
from fareloom.plans.medallion import maintain, refresh, refresh_partitions
from fareloom.session import shared_root


@pytest.fixture
def lake(spark):
    return registry.scratch_lake(spark, "test")


@pytest.fixture
def silver(spark, sf_dir):
    return registry.silver(spark, sf_dir).drop("ingestion_timestamp")


def files(lake, layer):
    return lake.read(layer).select("_metadata.file_path").distinct().count()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_without_it_the_warehouse_is_taken(spark):
    """Whatever the session's master is called."""
    settings = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, *default: settings.get(name, *default)),
        sparkContext=SimpleNamespace(applicationId="app-1"),
    )
    assert shared_root(session) == "hdfs:///warehouse/fareloom-app-1"


def test_refresh_writes_all_layers(spark, sf_dir, lake):
    raw = registry.trips(spark, sf_dir).drop("event_id")
    reports = refresh(lake, raw)
    assert {layer: r.rows for layer, r in reports.items()} == {
        "raw": 10_000,
        "bronze": 7_534,
        "silver": 6_665,
        "gold": 1_655,
    }
    assert lake.partitioning("silver") == list(PARTITIONING)
    counted = {r["layer"]: r["n_rows"] for r in lake.counts().collect()}
    assert counted == {layer: r.rows for layer, r in reports.items()}
    statistics = maintain(lake)
    assert statistics["silver"]["rows"] == 6_665
    assert lake.read("gold").count() == 1_655


def test_unknown_layer_is_an_error(lake):
    with pytest.raises(KeyError, match="platinum"):
        lake.table("platinum")


def test_partition_filter_prunes(lake, silver):
    lake.write("silver", silver, PARTITIONING)
    frame = lake.read("silver").filter("taxi_type = 'yellow' AND pickup_month = 5")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "taxi_type" in filters and "pickup_month" in filters


def test_only_touched_partitions_are_replaced(lake, silver):
    lake.write("silver", silver, PARTITIONING)
    before = {r["source_file"]: r["count"] for r in lake.read("silver").groupBy("source_file").count().collect()}
    may = lake.read("silver").filter("pickup_month = 5 AND taxi_type = 'green'").limit(7)
    lake.write_partitions("silver", may)
    after = {r["source_file"]: r["count"] for r in lake.read("silver").groupBy("source_file").count().collect()}
    changed = {name for name in before if before[name] != after.get(name)}
    assert changed == {"green_tripdata_2024-05.parquet"}
    assert after["green_tripdata_2024-05.parquet"] == 7


def test_new_partition_appears(lake, silver):
    lake.write("silver", silver.filter("pickup_month < 5"), PARTITIONING)
    lake.write_partitions("silver", silver.filter("pickup_month = 5"))
    assert lake.read("silver").count() == 6_665


def test_failed_write_leaves_the_table(lake, silver):
    lake.write("silver", silver)
    broken = silver.withColumn("total_amount", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        lake.write("silver", broken)
    assert lake.read("silver").count() == 6_665


def test_compaction_keeps_rows(lake, silver):
    lake.write("silver", silver.repartition(20), PARTITIONING)
    many, revenue = files(lake, "silver"), lake.read("silver").agg(F.sum("event_id")).first()[0]
    lake.compact("silver")
    assert files(lake, "silver") < many
    assert lake.read("silver").agg(F.sum("event_id")).first()[0] == revenue
    lake.write("gold", silver.repartition(20))
    lake.compact("gold")
    assert files(lake, "gold") == 1
    assert lake.compact("gold") is None
    assert lake.read("gold").count() == 6_665


def test_clustering_keeps_rows(lake, silver):
    lake.write("silver", silver, PARTITIONING)
    lake.cluster("silver", "tpep_pickup_datetime", target_bytes=lake.size("silver") // 8)
    assert lake.read("silver").count() == 6_665
    assert lake.partitioning("silver") == list(PARTITIONING)


def test_sql_over_the_current_schema(spark, sf_dir, lake):
    lake.write("gold", registry.gold(spark, sf_dir))
    lake.use()
    try:
        row = spark.sql(
            "SELECT ROUND(SUM(sum_total_amount) / SUM(total_trips), 2) AS fare "
            "FROM gold_trips WHERE taxi_type = 'yellow'"
        ).first()
    finally:
        spark.sql("USE default")
    assert row["fare"] == 57.57


KEYS = ["007", "7", "it's", "a b/c", None, "x=y%"]


def test_partition_values_are_what_they_are(spark, lake):
    """Numbers as text, quotes, separators and null, rewritten in place twice."""
    rows = [(key, i, float(i)) for i, key in enumerate(KEYS)]
    frame = spark.createDataFrame(rows, "taxi_type string, pickup_year int, total_amount double")
    for _ in range(2):
        lake.write("silver", frame, ["taxi_type"])
        lake.write_partitions("silver", lake.read("silver"))
        found = lake.read("silver").select("taxi_type", "pickup_year", "total_amount").collect()
        assert sorted(map(tuple, found), key=str) == sorted(rows, key=str)
    lake.write("silver", frame.where("taxi_type = '007' OR taxi_type IS NULL"), ["taxi_type"])
    assert lake.read("silver").count() == 2


def test_a_late_column_is_added_and_a_rerun_changes_nothing(lake, silver):
    lake.write("silver", silver, PARTITIONING)
    may = silver.filter("pickup_month = 5").withColumn("tip_amount", F.lit(2.5))
    for _ in range(2):
        lake.write_partitions("silver", may)
        table = lake.read("silver")
        assert table.count() == 6_665
        assert table.filter("tip_amount = 2.5").count() == may.count()
        assert table.filter("tip_amount IS NULL AND pickup_month = 5").count() == 0
    lake.write("silver", silver, PARTITIONING)  # columns stay
    assert "tip_amount" in lake.read("silver").columns


def test_data_is_below_the_location(lake, silver):
    lake.write("silver", silver, PARTITIONING)
    lake.write("gold", silver)
    for layer in ("silver", "gold"):
        paths = [row["path"] for row in lake.files(layer).collect()]
        root = lake.location.removeprefix("file:")
        assert paths and all(f"{root}/{lake.tables[layer]}/v-" in path for path in paths)


@pytest.mark.parametrize("partitioned", [True, False])
def test_old_folders_go_on_request(lake, silver, partitioned):
    keys = PARTITIONING if partitioned else ()
    first = lake.write("silver", silver, keys)
    second = lake.write("silver", silver, keys)
    third = None
    if partitioned:
        third = lake.write_partitions("silver", silver.filter("pickup_month = 5"))
    assert lake.expire("silver") == [first.path]
    assert lake.expire("silver") == []
    assert lake.read("silver").count() == 6_665
    last = lake.write("silver", silver, keys)
    assert lake.expire("silver") == [r.path for r in (second, third) if r] and last.path


@pytest.mark.parametrize("step", range(9))
def test_death_at_any_step_leaves_a_whole_table(spark, lake, silver, step):
    """The n-th change of the catalogue does not happen; then the job is dead."""
    before = silver.filter("pickup_month = 5")
    lake.write("silver", before, PARTITIONING)
    after = before.withColumn("total_amount", F.col("total_amount").cast("float"))  # another type

    class Dies:
        def __init__(self, session):
            self.session, self.left = session, step

        def __getattr__(self, name):
            return getattr(self.session, name)

        def sql(self, text):
            if text.startswith(("CREATE", "DROP", "ALTER")):
                self.left -= 1
                if self.left < 0:
                    raise RuntimeError("dead")
            return self.session.sql(text)

    dying = type(lake)(Dies(spark), lake.schema, lake.location)
    try:
        dying.write("silver", after, PARTITIONING)
    except RuntimeError:
        pass
    lake.recover("silver")
    assert lake.read("silver").count() == before.count()
    lake.write("silver", after, PARTITIONING)
    assert dict(lake.read("silver").dtypes)["total_amount"] == "float"


def test_one_large_and_many_small_files_are_compacted(lake, silver):
    month = silver.filter("taxi_type = 'yellow' AND pickup_month = 5")
    lake.write("silver", month.coalesce(1).union(month.limit(36).repartition(12)), PARTITIONING)
    sizes = [row["length"] for row in lake.files("silver").collect()]
    assert len(sizes) == 13
    report = lake.compact("silver", target_bytes=8 * sum(sizes) // len(sizes))
    assert report is not None and files(lake, "silver") < 13
    assert lake.read("silver").count() == month.count() + 36


def gold_rows(lake):
    measures = ("total_trips", "min_total_amount", "max_total_amount")
    keys = ("taxi_type", "year_month", "pickup_hour", "pickup_dayname")
    return sorted(tuple(r[c] for c in (*keys, *measures)) for r in lake.read("gold").collect())


def test_refreshing_parts_equals_refreshing_all(spark, sf_dir, lake):
    """New files, a file delivered again with other trips, one with a trip of
    another month, and a month of pickup that goes away."""
    trips = registry.trips(spark, sf_dir).drop("event_id")
    march, may = F.col("year_month") == "2024-03", F.col("year_month") == "2024-05"
    stray = trips.where(march).limit(5).withColumns(
        {
            name: F.col(name) + F.expr("INTERVAL '800' DAY")
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    first = trips.where(~march & ~may).unionByName(stray)
    early = trips.where(march).limit(20).withColumns(
        {
            name: F.col(name) - F.expr("INTERVAL '20' DAY")
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    later = trips.where(march | may).unionByName(early)
    refresh(lake, first)
    refresh_partitions(lake, later)
    whole = registry.scratch_lake(spark, "whole")
    refresh(whole, trips.where(~march & ~may).unionByName(later))
    assert gold_rows(lake) == gold_rows(whole)
    assert lake.read("silver").count() == whole.read("silver").count()
    before = gold_rows(lake)
    refresh_partitions(lake, later)  # once more: nothing changes
    assert gold_rows(lake) == before


def test_events_of_another_type_are_trips_too(spark, tmp_path):
    rows = [(i, ("view", "error", "sixth", None)[i % 4]) for i in range(400)]
    frame = spark.createDataFrame(rows, "event_id bigint, event_type string").selectExpr(
        "event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "1L AS user_id", "event_type",
        "5.0D AS value", "'{}' AS props",
    )
    frame.write.parquet(f"{tmp_path}/events.parquet")
    assert registry.trips(spark, str(tmp_path)).count() == 400
    fleets = registry.fleet_frames(spark, str(tmp_path))
    assert {name: f.count() for name, f in fleets.items()} == {"yellow": 100, "green": 300}
