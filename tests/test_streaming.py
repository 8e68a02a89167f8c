"""File streams end with the same tables as the batch layers."""

import pytest

from fareloom.contract import FLEETS
from fareloom.plans import registry
from fareloom.session import fresh_path
from fareloom.streaming.arrivals import append_silver, arriving_trips, keep_gold


@pytest.fixture
def folders(spark, sf_dir):
    base = registry.plain_folder(spark, sf_dir)
    frames = registry.fleet_frames(spark, sf_dir)
    return {name: (f"{base}/{name}", frames[name].schema) for name in FLEETS}


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_gold_from_a_stream(spark, sf_dir, folders):
    lake = registry.scratch_lake(spark, "stream")
    checkpoint = fresh_path(spark, "stream-checkpoint")
    finish(keep_gold(arriving_trips(spark, folders, files_per_batch=2), lake, checkpoint))
    streamed = {tuple(r)[:7] + (r["total_trips"],) for r in lake.read("gold").collect()}
    batch = {tuple(r)[:7] + (r["total_trips"],) for r in registry.gold(spark, sf_dir).collect()}
    assert streamed == batch


def test_silver_rows_are_added_once(spark, sf_dir, folders):
    path, checkpoint = fresh_path(spark, "stream-silver"), fresh_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run finds no new file
        finish(append_silver(arriving_trips(spark, folders, extra=("event_id",)), path, checkpoint))
    rows = spark.read.parquet(path)
    assert rows.count() == 6_665
    assert rows.select("event_id").distinct().count() == 6_665
    assert {r[0] for r in rows.select("source_file").distinct().collect()} == {
        f"{fleet}_tripdata_2024-0{m}.parquet" for fleet in FLEETS for m in range(1, 6)
    }
