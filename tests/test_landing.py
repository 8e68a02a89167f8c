"""Monthly trip files: names, manifest, damaged files and drifting schemas."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareloom.sources import landing

T = dt.datetime(2024, 1, 5, 8)


def write_file(folder, fleet, month, passengers, **extra):
    prefix = "lpep" if fleet == "green" else "tpep"
    n = len(passengers)
    table = pa.table(
        {
            "VendorID": pa.array(range(n), pa.int64()),
            "passenger_count": passengers,
            f"{prefix}_pickup_datetime": pa.array([T] * n, pa.timestamp("us")),
            f"{prefix}_dropoff_datetime": pa.array([T] * n, pa.timestamp("us")),
            "total_amount": pa.array([5.0] * n),
            **{name: pa.array([value] * n) for name, value in extra.items()},
        }
    )
    pq.write_table(table, folder / f"{fleet}_tripdata_{month}.parquet")


@pytest.fixture
def folder(tmp_path):
    write_file(tmp_path, "yellow", "2024-01", pa.array([1.0, 2.0]))
    write_file(tmp_path, "yellow", "2024-02", pa.array([3, 4, 5], pa.int64()), tip_amount=1.5)
    write_file(tmp_path, "green", "2024-01", pa.array([1.0]))
    (tmp_path / "green_tripdata_2024-02.parquet").write_bytes(b"not parquet at all")
    return tmp_path


def test_damaged_file_is_reported_and_the_rest_is_read(spark, folder):
    result = landing.ingest(spark, landing.landing_entries(spark, str(folder)))
    failed = [o.entry.file_name for o in result.outcomes if not o.ok]
    assert failed == ["green_tripdata_2024-02.parquet"]
    counts = {r["source_file"]: r["count"] for r in result.raw.groupBy("source_file").count().collect()}
    assert counts == {
        "yellow_tripdata_2024-01.parquet": 2,
        "yellow_tripdata_2024-02.parquet": 3,
        "green_tripdata_2024-01.parquet": 1,
    }


def test_drifting_types_meet_the_contract(spark, folder):
    raw = landing.ingest(spark, landing.landing_entries(spark, str(folder))).raw
    assert dict(raw.dtypes)["passenger_count"] == "double"
    assert raw.agg(F.sum("passenger_count")).first()[0] == 16.0
    assert raw.filter("tip_amount IS NULL").count() == 3


def test_entry_order_has_no_effect(spark, folder):
    entries = landing.landing_entries(spark, str(folder))
    one, two = (landing.ingest(spark, e).raw for e in (entries, entries[::-1]))
    columns = ["taxi_type", "source_file", "VendorID", "tpep_pickup_datetime"]
    assert sorted(one.select(columns).collect()) == sorted(two.select(columns).collect())
    assert one.filter("tpep_pickup_datetime IS NULL").count() == 0


def test_a_fleet_filter_drops_the_other_scans(spark, folder):
    raw = landing.ingest(spark, landing.landing_entries(spark, str(folder))).raw
    plan = raw.filter("taxi_type = 'green'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_no_readable_file_is_an_error(spark, tmp_path):
    (tmp_path / "green_tripdata_2024-02.parquet").write_bytes(b"broken")
    with pytest.raises(ValueError, match="no trip file"):
        landing.ingest(spark, landing.landing_entries(spark, str(tmp_path)))
    with pytest.raises(ValueError, match="no entries"):
        landing.ingest(spark, [])


@pytest.mark.parametrize(
    "name,expected",
    [
        ("yellow_tripdata_2024-01.parquet", ("yellow", "2024-01")),
        ("green_tripdata_2024_01.parquet", ("green", "2024-01")),
        ("green_tripdata_2024_01_v2.parquet", ("green", "2024-01")),
        ("yellow_tripdata.parquet", (None, None)),
        ("yellow_tripdata_2024-01.csv", (None, None)),
        ("part-0000.parquet", (None, None)),
    ],
)
def test_file_names(spark, name, expected):
    frame = spark.createDataFrame([(name,)], "name string")
    parsed = landing.parse_name(F.col("name"))
    row = frame.select(*(v.alias(k) for k, v in parsed.items())).first()
    assert tuple(row) == expected


@pytest.mark.parametrize(
    "path",
    [
        "file:/data/yellow_tripdata_2024-01.parquet",
        "file:/data/yellow_tripdata_2024-01.parquet/part-00000-ab.snappy.parquet",
        "file:/data/entry=yellow_tripdata_2024-01.parquet/part-00000-ab.snappy.parquet",
    ],
)
def test_entry_name(spark, path):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(landing.entry_name(F.col("path"))).first()[0] == (
        "yellow_tripdata_2024-01.parquet"
    )


def test_manifest_sizes(spark, folder):
    rows = landing.manifest(landing.list_files(spark, str(folder))).collect()
    sizes = {row["source_file"]: row["n_bytes"] for row in rows}
    assert sizes == {p.name: p.stat().st_size for p in folder.iterdir()}
    total = landing.manifest_total(landing.manifest(landing.list_files(spark, str(folder)))).first()
    assert total["total_mb"] == pytest.approx(sum(sizes.values()) / 1048576)


def test_missing_entries(spark, folder):
    present = landing.manifest(landing.list_files(spark, str(folder)))
    expected = landing.expected_entries(spark, ["yellow", "green"], "2023-12", "2024-02")
    missing = landing.missing_entries(expected, present).collect()
    assert {(r["taxi_type"], r["year_month"]) for r in missing} == {
        ("yellow", "2023-12"),
        ("green", "2023-12"),
    }


def test_success_rate(spark, folder):
    result = landing.ingest(spark, landing.landing_entries(spark, str(folder)))
    outcomes = landing.entry_outcomes(landing.outcome_frame(spark, result.outcomes))
    row = landing.success_rate(outcomes).first()
    assert tuple(row) == (4, 3, 1, 75.0)


def test_a_name_in_two_folders_is_read_twice(spark, tmp_path):
    for part, n in (("a", 3), ("b", 2)):
        (tmp_path / part).mkdir()
        write_file(tmp_path / part, "yellow", "2024-01", pa.array([1.0] * n))
    result = landing.ingest(spark, landing.landing_entries(spark, str(tmp_path)))
    assert result.raw.count() == 5
    assert sorted(o.n_rows for o in result.outcomes) == [2, 3]
    row = landing.entry_outcomes(landing.outcome_frame(spark, result.outcomes)).first()
    assert (row["n_rows"], row["n_files"], row["status"]) == (5, 2, "ok")


@pytest.mark.parametrize("late", [0, 1])
def test_delivery_folders_with_any_part_names(spark, tmp_path, late):
    """Parts named otherwise, a column in one of them, a damaged and an empty part."""
    folder = tmp_path / "green_tripdata_2024-03.parquet"
    folder.mkdir()
    for i in range(2):
        extra = {"tip_amount": 1.0} if i == late else {}
        write_file(folder, "green", "2024-03", pa.array([1.0, 2.0]), **extra)
        (folder / "green_tripdata_2024-03.parquet").rename(folder / f"data_{i}.parquet")
    write_file(folder, "green", "2024-03", pa.array([], pa.float64()))
    (folder / "green_tripdata_2024-03.parquet").rename(folder / "data_2.parquet")
    (folder / "data_3.parquet").write_bytes(b"broken")
    (tmp_path / "notes.parquet").write_bytes(b"no trip file's name")
    result = landing.ingest(spark, landing.landing_entries(spark, str(tmp_path)))
    assert result.raw.count() == 4
    assert result.raw.filter("tip_amount = 1.0").count() == 2
    assert {r[0] for r in result.raw.select("source_file").distinct().collect()} == {folder.name}
    found = {o.entry.path.rsplit("/", 1)[1]: (o.status, o.n_rows) for o in result.outcomes}
    assert found == {
        "data_0.parquet": ("ok", 2),
        "data_1.parquet": ("ok", 2),
        "data_2.parquet": ("ok", 0),
        "data_3.parquet": ("failed", 0),
        "notes.parquet": ("skipped", 0),
    }
    assert sum(o.entry.n_bytes for o in result.outcomes) == sum(
        p.stat().st_size for p in tmp_path.rglob("*.parquet") if p.is_file()
    )


def test_one_scan_per_fleet_and_column_types(spark, tmp_path):
    for month in range(1, 13):
        kind = pa.int64() if month % 4 == 0 else pa.float64()
        write_file(tmp_path, "yellow", f"2024-{month:02}", pa.array([1, 2], kind))
        write_file(tmp_path, "green", f"2024-{month:02}", pa.array([1.0]))
    raw = landing.ingest(spark, landing.landing_entries(spark, str(tmp_path))).raw
    assert raw.count() == 36
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3
