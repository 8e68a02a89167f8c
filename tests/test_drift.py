"""Files whose columns have other types, and footers read in one pass."""

import datetime as dt
import itertools
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fareloom.operators import drift
from fareloom.sources import footers, landing

T = dt.datetime(2024, 1, 5, 8)


def write_file(path, **columns):
    base = {
        "VendorID": pa.array([1, 2, 3], pa.int64()),
        "passenger_count": pa.array([1.0, 2.0, None]),
        "tpep_pickup_datetime": pa.array([T] * 3, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([T] * 3, pa.timestamp("us")),
        "total_amount": pa.array([5.0, 6.5, 7.0]),
    }
    pq.write_table(pa.table(base | columns), path)


@pytest.fixture
def folder(tmp_path):
    write_file(tmp_path / "yellow_tripdata_2024-01.parquet")
    write_file(
        tmp_path / "yellow_tripdata_2024-02.parquet",
        total_amount=pa.array(["12.5", "n/a", None]),
        VendorID=pa.array([1.0, 2.5, float("nan")]),
        note=pa.array([1, 2, 3], pa.int32()),
    )
    write_file(
        tmp_path / "yellow_tripdata_2024-03.parquet",
        tpep_pickup_datetime=pa.array(["2024-03-01 10:00:00", "soon", "2024-03-02 00:00:00.25"]),
        passenger_count=pa.array([b"1", b"2", b"3"]),
        note=pa.array(["x", "y", None]),
    )
    return tmp_path


def test_odd_values_are_null_and_counted(spark, folder):
    result = landing.ingest(spark, landing.landing_entries(spark, str(folder)))
    lost = {o.entry.year_month: (o.status, o.n_rows, dict(o.lost)) for o in result.outcomes}
    assert lost == {
        "2024-01": ("ok", 3, {}),
        "2024-02": ("ok", 3, {"total_amount": 1, "VendorID": 2}),
        "2024-03": ("ok", 3, {"tpep_pickup_datetime": 1, "passenger_count": 3}),
    }
    rows = {}
    for row in result.raw.collect():
        rows.setdefault(row["year_month"], []).append(row)
    assert [r["total_amount"] for r in rows["2024-02"]] == [12.5, None, None]
    assert [r["VendorID"] for r in rows["2024-02"]] == [1, None, None]
    assert [r["tpep_pickup_datetime"] for r in rows["2024-03"]] == [
        dt.datetime(2024, 3, 1, 10), None, dt.datetime(2024, 3, 2, 0, 0, 0, 250_000),
    ]
    assert [r["note"] for r in rows["2024-02"] + rows["2024-03"]] == ["1", "2", "3", "x", "y", None]
    table = landing.lost_values(landing.outcome_frame(spark, result.outcomes))
    assert table.count() == 4 and table.where("n_rows = 3").count() == 4


KINDS = [*drift.PLAIN, "decimal(10,2)", "binary", "array<int>"]


def test_promotion_is_a_lattice():
    for a, b, c in itertools.product(KINDS, repeat=3):
        assert drift.wider(a, b) == drift.wider(b, a)
        assert drift.wider(a, a) == a
        assert drift.wider(drift.wider(a, b), c) == drift.wider(a, drift.wider(b, c)), (a, b, c)
    assert drift.wider("int", "bigint") == "bigint" and drift.wider("bigint", "double") == "double"
    assert drift.wider("date", "timestamp_ntz") == "timestamp_ntz"
    assert drift.wider("boolean", "int") == "string"


@pytest.mark.parametrize("kind", ["bigint", "double", "timestamp_ntz", "string", "timestamp"])
def test_every_type_can_be_asked_for(spark, kind):
    """No pair of types fails to analyse or to run."""
    for own in KINDS:
        frame = spark.sql(f"SELECT CAST(NULL AS {own}) AS x")
        got = frame.selectExpr(f"{drift.as_type('x', own, kind)} AS y")
        assert got.first()["y"] is None


def test_footers_are_what_spark_reads(spark, folder, sf_dir):
    (folder / "broken.parquet").write_bytes(b"PAR1 no footer PAR1")
    spark.sql(
        "SELECT TIMESTAMP'2024-01-01 00:00:00' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS b, "
        "DATE'2024-01-01' AS c, CAST(1 AS DECIMAL(12,3)) AS d, array(1) AS e, X'00' AS f, true AS g, "
        "CAST(1 AS TINYINT) AS h, CAST(1 AS FLOAT) AS i, named_struct('x', 1L) AS j"
    ).write.parquet(f"{folder}/kinds")
    paths = [r["path"] for r in landing.list_files(spark, str(folder)).collect()]
    found = {r["path"]: r for r in footers.read_footers(spark, paths).collect()}
    assert set(found) == set(paths)
    for path, row in found.items():
        if path.endswith("broken.parquet"):
            assert row["error"] and not row["columns"]
            continue
        frame = spark.read.parquet(path)
        own = {c["name"]: c["kind"] for c in row["columns"]}
        assert own == {f.name: f.dataType.simpleString() for f in frame.schema}
        assert row["n_rows"] == frame.count()


def test_files_of_other_stores_are_read_by_spark(spark, folder, monkeypatch):
    paths = [r["path"] for r in landing.list_files(spark, str(folder)).collect()]
    known = sorted(footers.read_footers(spark, paths).collect())
    monkeypatch.setattr(footers, "_OPENED", {})
    assert sorted(footers.read_footers(spark, paths).collect()) == known


def jobs_of(spark, folder):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "ingest")
    result = landing.ingest(spark, landing.landing_entries(spark, str(folder)))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return jobs, result


def test_jobs_do_not_grow_with_files_or_damage(spark, tmp_path):
    jobs = []
    for n in (120, 480):  # both beyond the 32 paths from which on Spark lists in a job
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            path = folder / f"yellow_tripdata_2024-01_{i:04}.parquet"
            if i % 20 == 7:
                path.write_bytes(b"damaged")
            else:
                write_file(path, **({"total_amount": pa.array(["1", "-", ""])} if i % 3 else {}))
        count, result = jobs_of(spark, folder)
        jobs.append(count)
        assert sum(not o.ok for o in result.outcomes) == n // 20
        assert result.raw.count() == 3 * (n - n // 20)
    assert jobs[0] == jobs[1]
