"""Refreshes that die and are run again, zones, quarantine, hashes, sketches, z-order."""

import pytest
from pyspark.sql import functions as F

from fareloom.contract import AMOUNT, FLEET, MONTH, PARTITIONING, PICKUP
from fareloom.operators import distribution, zorder
from fareloom.operators.quality import REASONS
from fareloom.plans import registry
from fareloom.plans.medallion import Layers, finish_refresh, refresh, refresh_partitions
from fareloom.sinks import hashes, quarantine, sketches, zones
from fareloom.sinks.journal import Journal


@pytest.fixture
def lake(spark):
    return registry.scratch_lake(spark, "test")


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return registry.silver(spark, sf_dir).drop("ingestion_timestamp")


@pytest.fixture(scope="module")
def some_trips(spark, sf_dir):
    """A seventh of the trips of three months, in a table: refreshes of them are quick."""
    path = registry.fresh_path(spark, "some-trips")
    registry.trips(spark, sf_dir).where("event_id % 7 = 0 AND event_id % 5 < 3").coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(lake, layer, columns):
    return sorted((tuple(r) for r in lake.read(layer).select(*columns).collect()), key=str)


def state(lake):
    gold = ("taxi_type", "year_month", "pickup_hour", "pickup_dayname", "total_trips", "max_total_amount")
    return rows_of(lake, "gold", gold), *(
        rows_of(lake, layer, (FLEET, PICKUP, AMOUNT)) for layer in ("bronze", "silver")
    )


def moved(trips, days):
    step = F.expr(f"INTERVAL '{days}' DAY")
    return trips.withColumns(
        {name: F.col(name) + step for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )


class Dying:
    """A session whose n-th change of the catalogue does not happen."""

    def __init__(self, session, left):
        self.session, self.left = session, left

    def __getattr__(self, name):
        return getattr(self.session, name)

    def sql(self, text):
        if text.startswith(("CREATE", "DROP", "ALTER")):
            self.left -= 1
            if self.left < 0:
                raise RuntimeError("dead")
        return self.session.sql(text)


def deliveries(trips):
    """What came first, and what comes now: March again, with other trips, one of
    which moves to another month, and some that had been in another month go."""
    march = F.col("year_month") == "2024-03"
    strays = moved(trips.where(march).orderBy("event_id").limit(5), 70)
    first = trips.where(~march).unionByName(strays)
    again = moved(trips.where(march), 0).unionByName(
        moved(trips.where(march).orderBy("event_id").limit(3), -20)
    )
    return first.drop("event_id"), again.drop("event_id")


def test_deaths_at_any_change_of_the_catalogue(spark, some_trips):
    first, again = deliveries(some_trips)
    whole = registry.scratch_lake(spark, "whole")
    march = F.col("year_month") == "2024-03"
    refresh(whole, first.where(~march).unionByName(again))
    wanted = state(whole)
    for step in (0, 4, 11):
        lake = registry.scratch_lake(spark, "dying")
        refresh(lake, first)
        dying = type(lake)(Dying(spark, step), lake.schema, lake.location)
        with pytest.raises(RuntimeError, match="dead"):
            refresh_partitions(dying, again)
        assert Journal(lake).pending()
        refresh_partitions(lake, again)
        assert state(lake) == wanted, step
        assert Journal(lake).pending() == set()


@pytest.mark.parametrize("layer", ["bronze", "gold"])
def test_a_death_behind_raw_is_finished_without_the_files(spark, some_trips, layer, lake):
    first, again = deliveries(some_trips)
    refresh(lake, first)
    dying = Layers()
    object.__setattr__(dying, layer, _dies_unless_counting(Layers(), layer))
    with pytest.raises(RuntimeError):
        refresh_partitions(lake, again, dying)
    finish_refresh(lake)
    whole = registry.scratch_lake(spark, "whole")
    refresh(whole, first.where("year_month != '2024-03'").unionByName(again))
    assert state(lake) == state(whole)


def _dies_unless_counting(layers, layer):
    """The layer function, which dies when it is called to write the layer."""
    calls = {"bronze": 2, "silver": 0, "gold": 0}  # bronze is asked twice for its months
    left = [calls[layer]]

    def run(frame):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("dead")
        return getattr(layers, layer)(frame)

    return run


def test_an_incomplete_intent_does_not_count(lake):
    journal = Journal(lake)
    assert journal.pending() == set()
    journal.intend({("yellow", 2024, 3)})
    journal.intend({("green", 2023, 12), ("yellow", 2024, 3)})
    assert journal.pending() == {("yellow", 2024, 3), ("green", 2023, 12)}
    lake.spark.range(3).write.format("noop").mode("overwrite").save()
    lake.spark.range(1).selectExpr("'x' AS taxi_type").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{journal.root}/half")
    assert journal.pending() == {("yellow", 2024, 3), ("green", 2023, 12)}
    journal.done()
    assert journal.pending() == set()


def files_scanned(frame):
    """Files that the scans of an executed plan have read."""
    frame.write.format("noop").mode("overwrite").save()
    plan = frame._jdf.queryExecution().executedPlan()
    frame.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        metric = node.metrics().get("numFiles")
        found += metric.get().value() if metric.isDefined() else 0
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_files_read_grow_with_the_months_touched(spark, some_trips, lake):
    refresh(lake, some_trips.drop("event_id"))
    all_files = lake.files("raw").count()
    one = zones.rows_of(lake, [("yellow", 2024, 3)])
    two = zones.rows_of(lake, [("yellow", 2024, 3), ("yellow", 2024, 2), ("green", 2024, 2)])
    scanned = files_scanned(one), files_scanned(two)
    assert 0 < scanned[0] < scanned[1] < all_files
    wanted = some_trips.where("taxi_type = 'yellow' AND month(tpep_pickup_datetime) = 3")
    assert one.where("month(tpep_pickup_datetime) = 3").count() == wanted.count()


def test_files_without_a_zone_are_read(spark, some_trips, lake):
    refresh(lake, some_trips.drop("event_id"))
    lake.drop_partitions(zones.ZONES, [("green", "2024-02")])
    files = zones.files_of(lake, [("yellow", 2024, 3)])
    assert any("taxi_type=green" in path for path in files)
    lake.spark.sql(f"DROP TABLE {lake.table(zones.ZONES)}")
    assert len(zones.files_of(lake, [("yellow", 2024, 3)])) == lake.files("raw").count()


def test_kept_and_rejected_rows_are_all_rows(spark, some_trips, lake):
    source = some_trips.drop("event_id")
    reports = refresh(lake, source, quarantine=True)
    assert reports["bronze"].rows + reports["bronze_rejects"].rows == source.count()
    assert reports["silver"].rows + reports["silver_rejects"].rows == reports["bronze"].rows
    plain = registry.scratch_lake(spark, "plain")
    refresh(plain, source)
    assert state(lake) == state(plain)
    gone = lake.read("bronze_rejects")
    assert gone.where(f"size({REASONS}) = 0 OR {REASONS} IS NULL").count() == 0
    assert lake.partitioning("bronze_rejects") == list(PARTITIONING)
    refresh(lake, source.where("total_amount > 0 AND passenger_count = 1"), quarantine=True)
    for layer in ("bronze", "silver"):
        lake.expire(layer)
        assert lake.read(quarantine.rejects(layer)).count() >= 0


def test_quarantine_is_one_scan_and_one_write(spark, some_trips):
    judged = Layers().judged_bronze(some_trips)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_no_rejects_and_nothing_but_rejects(spark, some_trips, lake):
    good = Layers().bronze(some_trips).drop("event_id")
    columns = [c for c in some_trips.columns if c in good.columns]
    reports = quarantine.divide(lake, "bronze", Layers().judged_bronze(good.select(columns)))
    assert (reports["bronze"].rows, reports["bronze_rejects"].rows) == (good.count(), 0)
    assert lake.read("bronze_rejects").count() == 0
    bad = good.select(columns).withColumn(AMOUNT, F.lit(-1.0))
    reports = quarantine.divide(lake, "bronze", Layers().judged_bronze(bad))
    assert lake.read("bronze").count() == 0
    assert lake.read("bronze_rejects").count() == good.count()


def test_a_changed_row_names_its_file(spark, silver, lake):
    lake.write("silver", silver, PARTITIONING, rebalance=True)
    before = hashes.snapshot(lake, "silver")
    assert hashes.differences(spark, before, hashes.snapshot(lake, "silver", before), PARTITIONING).count() == 0
    march = lake.read("silver").where(F.col(MONTH) == 3)
    raised = F.when(F.col("event_id") == march.agg(F.min("event_id")).first()[0], 1.0)
    changed = march.withColumn(AMOUNT, F.coalesce(raised, AMOUNT))
    lake.write_partitions("silver", changed)
    after = hashes.snapshot(lake, "silver", before)
    assert hashes.level(spark.read.parquet(after)).first() == hashes.level(
        spark.read.parquet(hashes.snapshot(lake, "silver"))
    ).first()
    files = hashes.differences(spark, before, after, PARTITIONING)
    assert {r[MONTH] for r in files.collect()} == {3}
    rows = hashes.changed_rows(lake, "silver", files)
    assert sorted(r["side"] for r in rows.collect()) == ["after", "before"]
    assert files_scanned(rows) <= 4 * files.count()


def test_only_new_files_are_hashed(spark, silver, lake, monkeypatch):
    lake.write("silver", silver, PARTITIONING, rebalance=True)
    before = hashes.snapshot(lake, "silver")
    lake.write_partitions("silver", lake.read("silver").where(F.col(MONTH) == 3))
    read = []
    hashed = hashes.file_hashes
    monkeypatch.setattr(hashes, "file_hashes", lambda rows, keys: read.append(rows) or hashed(rows, keys))
    hashes.snapshot(lake, "silver", before)
    assert 0 < files_scanned(read[0]) < lake.files("silver").count()


def test_the_cut_into_files_does_not_matter_above_files(spark, silver, lake):
    lake.write("silver", silver.repartition(7), PARTITIONING)
    one = spark.read.parquet(hashes.snapshot(lake, "silver"))
    lake.write("silver", silver.coalesce(1), PARTITIONING)
    other = spark.read.parquet(hashes.snapshot(lake, "silver"))
    columns = [*PARTITIONING, "n_rows", "hash"]
    tops = [sorted(map(tuple, hashes.level(t, *PARTITIONING).select(columns).collect())) for t in (one, other)]
    assert tops[0] == tops[1] and one.count() != other.count()


def test_sketches_follow_a_refresh(spark, some_trips, lake):
    first, again = deliveries(some_trips)
    refresh(lake, first)
    sketches.build(lake)
    refresh_partitions(lake, again)
    found = sketches.estimates(lake.read(sketches.SKETCHES), [500], [FLEET, MONTH])
    counts = lake.read("silver").groupBy(FLEET, MONTH).agg(F.count(AMOUNT).alias("n")).collect()
    got = {(r[FLEET], r[MONTH]): r["n_values"] for r in found.where(f"metric = '{AMOUNT}'").collect()}
    assert got == {(r[FLEET], r[MONTH]): r["n"] for r in counts}


def test_sketches_of_odd_columns(spark):
    rows = [("a", 1.0), ("a", float("nan")), ("a", None), ("b", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    made = sketches.sketch(frame, ["k"], ["v"])
    found = {r["k"]: r for r in sketches.estimates(made, [500], ["k"], ["v"]).collect()}
    assert (found["a"]["n_values"], found["a"]["quantiles"]) == (1, [1.0])
    assert (found["b"]["n_values"], found["b"]["quantiles"]) == (0, None)


def test_rank_errors_of_sketches(spark):
    """Sketches of 60 skewed parts, merged, against the exact ranks."""
    frame = spark.range(300_000).selectExpr(
        "id % 60 AS part", "pow(xxhash64(id) % 100000, 3) AS v", "IF(id % 3 = 0, 7D, id) AS w"
    )
    made = sketches.sketch(frame, ["part"], ["v", "w"])
    shares = [1, 100, 250, 500, 750, 990, 999]
    for row in sketches.estimates(made, shares, (), ["v", "w"]).collect():
        for share, value in zip(shares, row["quantiles"], strict=True):
            below, upto = frame.agg(
                F.count_if(F.col(row["metric"]) < value), F.count_if(F.col(row["metric"]) <= value)
            ).first()
            slack = sketches.RANK_ERROR * 300_000
            assert below - slack <= share * 300 <= upto + slack


def test_z_order_skips_files_by_either_column(spark, lake):
    frame = spark.range(40_000).selectExpr(
        "xxhash64(id, 1) % 1000 AS a", "IF(id % 3 = 0, 5D, xxhash64(id, 2) % 100000) AS b", "id"
    )
    lake.write("gold", frame.repartition(4))
    shares = {}
    for kind, arrange in (("z", lake.zorder), ("sorted", lake.cluster)):
        arrange("gold", "a", "b", target_bytes=lake.size("gold") // 64)
        assert lake.read("gold").agg(F.count("*"), F.sum("id")).first() == frame.agg(F.count("*"), F.sum("id")).first()
        ranges = lake.read("gold").groupBy("_metadata.file_path").agg(
            *(f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max)))
        ).collect()
        for column, low, high in (("a", 100, 120), ("b", 50_000.0, 52_000.0)):
            met = [r for r in ranges if r[f"lo_{column}"] <= high and r[f"hi_{column}"] >= low]
            shares[kind, column] = len(met) / len(ranges)
    assert shares["z", "a"] < 0.4 and shares["z", "b"] < 0.4
    assert shares["sorted", "b"] > 0.9  # an order by one column after the other


def test_ranks_and_interleaving(spark):
    frame = spark.sql(
        "SELECT explode(array(-5D, 0D, 1.5D, 2D, 9D, CAST('NaN' AS DOUBLE), NULL)) AS v"
    )
    ranks = frame.select("v", zorder.rank(F.col("v"), [0.0, 1.5, 2.0], 2).alias("r")).collect()
    assert [r["r"] for r in ranks] == [0, 1, 2, 3, 3, 3, 0]
    one = spark.range(1).select(zorder.z_value([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert one == 0b100111
    kinds = spark.sql(
        "SELECT DATE'2024-01-01' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS b, 'é' AS c, "
        "CAST(NULL AS STRING) AS d, 1 AS e, true AS f UNION ALL SELECT DATE'2024-01-02', "
        "TIMESTAMP_NTZ'2024-01-01 00:00:01', 'è', NULL, 2, false"
    )
    values = kinds.select(*(zorder.as_number(kinds, c).alias(c) for c in kinds.columns)).collect()
    assert values[0]["a"] < values[1]["a"] and values[0]["b"] < values[1]["b"]
    assert values[0]["c"] > values[1]["c"] and values[0]["d"] is None
    assert zorder.with_z(kinds, ["a", "c", "d"], "z").count() == 2
    assert zorder.with_z(kinds.limit(0), ["a", "c"], "z").count() == 0


def test_quantiles_of_groups_with_a_hot_one(spark):
    """Nine tenths of the rows in one group; a null key is a group too."""
    frame = spark.range(30_000).selectExpr(
        "IF(id % 10 > 0, 'hot', IF(id % 20 = 0, NULL, 'cold')) AS k",
        "IF(id % 7 = 0, NULL, CAST(xxhash64(id) % 5000 AS DOUBLE)) AS v", "1 AS metric_",
    )
    rows = distribution.group_quantiles(frame, ["v"], ["k"], (1, 500, 999)).collect()
    values = {}
    for r in frame.where("v IS NOT NULL").collect():
        values.setdefault(r["k"], []).append(r["v"])
    assert len(rows) == 3
    for row in rows:
        own = sorted(values[row["k"]])
        for p in (1, 500, 999):
            assert row[f"p{p}"] == own[max(1, -(-len(own) * p // 1000)) - 1]
        assert row["n_values"] == len(own)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, False)  # else ranges of so few values are joined
    try:
        ranged = distribution.in_ranges(distribution.value_counts(frame, ["v"], ["k"]), ["k"])
    finally:
        spark.conf.unset(name)
    hot = ranged.where("k = 'hot'").groupBy("part").count().collect()
    assert len(hot) > 1  # no task holds the hot group
