"""Monthly trip files: listing, manifest checks and fault-isolated reading."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from fareloom.contract import CONTRACT, FLEET, FLEETS, Fleet
from fareloom.operators.drift import as_type, losses, promoted
from fareloom.operators.unify import conform, rename_native, union_all
from fareloom.sources.footers import read_footers

SUFFIX = ".parquet"  # fixed value: trip files are <fleet>_tripdata_<yyyy-MM>.parquet
OK, FAILED, SKIPPED = "ok", "failed", "skipped"


@dataclass(frozen=True)
class Entry:
    """One delivered file. Fleet, month and name are null if no part of its path
    has the form of a trip file's name."""

    fleet: str | None
    year_month: str | None
    file_name: str | None
    path: str
    n_bytes: int = 0


@dataclass(frozen=True)
class Outcome:
    """What became of a file: read (with its rows, and the values per column that
    the column's type could not hold), failed (with the error), or skipped, as its
    name says no fleet and month."""

    entry: Entry
    status: str
    error: str | None = None
    n_rows: int = 0
    lost: Mapping[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.status == OK


@dataclass(frozen=True)
class Ingest:
    raw: DataFrame
    outcomes: list[Outcome] = field(default_factory=list)


def entry_name(path: Column) -> Column:
    """Name of the trip file a path belongs to; null if there is none.

    That is the last segment of the path that has the form of such a name: the
    file's own, or that of a folder whose part files make up the delivery. A
    `key=` in front is left out.
    """
    segments = F.reverse(F.split(path, "/"))
    names = F.transform(segments, lambda s: F.substring_index(s, "=", -1))
    return F.get(F.filter(names, lambda name: _fits(name)), F.lit(0))


def _name_parts(name: Column) -> Column:
    return F.split(F.regexp_replace(name, r"\.parquet$", ""), "_")


def _fits(name: Column) -> Column:
    return name.endswith(SUFFIX) & (F.size(_name_parts(name)) >= 3)


def parse_name(name: Column) -> dict[str, Column]:
    """Fleet and month from a file name; both null if the name has under three parts."""
    parts = _name_parts(name)
    count = F.size(parts)
    third = F.get(parts, F.lit(2))
    month = F.when(count >= 4, F.concat(third, F.lit("-"), F.get(parts, F.lit(3)))).otherwise(third)
    return {
        FLEET: F.when(_fits(name), F.get(parts, F.lit(0))),
        "year_month": F.when(_fits(name), month),
    }


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """Every data file below a folder with its size; no content is read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length")
        .withColumn("source_file", entry_name(F.col("path")))
    )
    return found.withColumns(parse_name(F.col("source_file")))


def manifest(files: DataFrame) -> DataFrame:
    """One row per trip file that has a proper name, with its size in MB."""
    return (
        files.filter(F.col(FLEET).isNotNull())
        .groupBy(FLEET, "year_month", "source_file")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
        )
        .withColumn("size_mb", F.col("n_bytes") / F.lit(1024 * 1024))
    )


def manifest_total(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.sum("n_files").alias("n_files"),
        F.sum("size_mb").alias("total_mb"),
    )


def expected_entries(
    spark: SparkSession, fleets: Sequence[str], first_month: str, last_month: str
) -> DataFrame:
    """The (fleet, month) pairs a complete landing folder holds."""
    months = F.sequence(
        F.to_date(F.lit(first_month), "yyyy-MM"),
        F.to_date(F.lit(last_month), "yyyy-MM"),
        F.expr("INTERVAL '1' MONTH"),
    )
    return (
        spark.range(1)
        .select(F.explode(F.array(*map(F.lit, fleets))).alias(FLEET), months.alias("months"))
        .select(FLEET, F.explode("months").alias("month"))
        .select(FLEET, F.date_format("month", "yyyy-MM").alias("year_month"))
    )


def missing_entries(expected: DataFrame, present: DataFrame) -> DataFrame:
    missing = expected.join(present, [FLEET, "year_month"], "left_anti")
    name = F.concat(F.col(FLEET), F.lit("_tripdata_"), F.col("year_month"), F.lit(SUFFIX))
    return missing.withColumn("source_file", name)


def landing_entries(spark: SparkSession, base: str) -> list[Entry]:
    """Every delivered file below a folder: a small record each on the driver,
    as Spark's own listing of what it reads."""
    rows = list_files(spark, base).orderBy("path").collect()
    return [
        Entry(row[FLEET], row["year_month"], row["source_file"], row["path"], row["length"])
        for row in rows
    ]


def typed(frame: DataFrame, others: Mapping[str, str] | None = None) -> DataFrame:
    """Contract columns in the contract's types, other columns in the given ones."""
    contract = {name.lower(): name for name in CONTRACT}
    inside = [contract[c.lower()] for c in frame.columns if c.lower() in contract]
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    rest = [
        f"{as_type(f'`{name}`', kind, (others or {}).get(name, kind))} AS `{name}`"
        for name, kind in kinds.items()
        if name.lower() not in contract
    ]
    return frame.selectExpr(*conform(frame, inside), *rest)


def with_provenance(
    files: DataFrame, fleet: Fleet, others: Mapping[str, str] | None = None
) -> DataFrame:
    """A fleet's files under canonical names and types, with where rows came from.

    The fleet is a literal, so a filter on it drops the scan; file name and month
    are worked out of the path, so a filter on them leaves out files.
    """
    name = entry_name(F.col("_metadata.file_path"))
    return typed(
        rename_native(files, fleet).withColumns(
            {
                FLEET: F.lit(fleet.name),
                "year_month": parse_name(name)["year_month"],
                "source_file": name,
                "ingestion_timestamp": F.current_timestamp(),
            }
        ),
        others,
    )


def _merge(one: Mapping[str, str], other: Mapping[str, str]) -> dict[str, str] | None:
    """Columns and types of both schemas; None if a column has two types."""
    if any(one.get(name, kind) != kind for name, kind in other.items()):
        return None
    return {**one, **other}


def _groups(schemas: Iterable[tuple[str, dict[str, str]]]) -> list[tuple[dict[str, str], list[str]]]:
    """Files, as pairs of path and schema, grouped so that a column has one type."""
    alike: dict[tuple, list[str]] = {}
    for path, schema in schemas:
        alike.setdefault(tuple(schema.items()), []).append(path)
    groups: list[tuple[dict[str, str], list[str]]] = []
    for columns, paths in alike.items():
        for i, (known, members) in enumerate(groups):
            merged = _merge(known, dict(columns))
            if merged is not None:
                groups[i] = (merged, members + paths)
                break
        else:
            groups.append((dict(columns), paths))
    return groups


def _frame(spark: SparkSession, schema: Mapping[str, str], paths: Sequence[str]) -> DataFrame:
    fields = [StructField(name, DataType.fromDDL(kind)) for name, kind in schema.items()]
    return spark.read.schema(StructType(fields)).parquet(*paths)


def _plain(path: str) -> str:
    """A path without what differs between listings of one file."""
    return unquote(path).replace("///", "/", 1)


def _lost(frames: Sequence[tuple[DataFrame, Fleet]]) -> dict[str, dict[str, int]]:
    """Values lost per file and canonical column, in one job over drifting columns."""
    counts = []
    for files, fleet in frames:
        renamed = rename_native(files, fleet)
        path = F.col("_metadata.file_path").alias("path")
        found = losses(renamed, CONTRACT, path)
        if found is not None:
            counts.append(found)
    lost: dict[str, dict[str, int]] = {}
    for row in union_all(counts).collect() if counts else []:
        lost.setdefault(_plain(row["path"]), {})[row["column_name"]] = row["n_lost"]
    return lost


def ingest(spark: SparkSession, entries: Iterable[Entry]) -> Ingest:
    """Read all files, in one scan per fleet and set of column types.

    Footers are read first, all in one job: a damaged file is left out alone, and
    files are grouped by the types of their columns. Every file has an outcome.
    Columns are renamed and typed before the union, which goes by name: a column
    that only some files have is null for the others, whatever the order of
    files, and one of several types takes the type that holds them all.
    """
    entries = list(entries)
    outcomes = [Outcome(e, SKIPPED) for e in entries if e.fleet is None]
    named = [e for e in entries if e.fleet is not None]
    footers = {}
    if named:
        footers = {row["path"]: row for row in read_footers(spark, [e.path for e in named]).collect()}
    schemas = {
        path: {column["name"]: column["kind"] for column in row["columns"]}
        for path, row in footers.items()
        if row["error"] is None
    }
    frames = []
    for name in sorted({e.fleet for e in named}):
        own = [(e.path, schemas[e.path]) for e in named if e.fleet == name and e.path in schemas]
        fleet = FLEETS.get(name, Fleet(name))
        frames += [(_frame(spark, schema, paths), fleet) for schema, paths in _groups(own)]
    lost = _lost(frames)
    for entry in named:
        footer = footers[entry.path]
        if footer["error"] is not None:
            outcomes.append(Outcome(entry, FAILED, footer["error"]))
        else:
            own = lost.get(_plain(entry.path), {})
            outcomes.append(Outcome(entry, OK, None, footer["n_rows"], own))
    if not frames:
        errors = "; ".join(o.error for o in outcomes if o.error) or "no entries"
        raise ValueError(f"no trip file could be read: {errors}")
    others = promoted(
        {f.name: f.dataType.simpleString() for f in rename_native(files, fleet).schema}
        for files, fleet in frames
    )
    raw = union_all([with_provenance(files, fleet, others) for files, fleet in frames])
    return Ingest(raw, sorted(outcomes, key=lambda o: o.entry.path))


def outcome_frame(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """The outcomes as a table: one row per file."""
    return spark.createDataFrame(
        [
            (
                o.entry.fleet, o.entry.year_month, o.entry.file_name, o.entry.path, o.status,
                o.error, o.n_rows, o.entry.n_bytes, dict(o.lost),
            )
            for o in outcomes
        ],
        f"{FLEET} string, year_month string, source_file string, path string, status string, "
        "error string, n_rows bigint, n_bytes bigint, n_lost map<string, bigint>",
    )


def entry_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per trip file name: failed if one of its files is."""
    named = outcomes.where(F.col("status") != SKIPPED)
    return named.groupBy("source_file", FLEET, "year_month").agg(
        F.when(F.bool_or(F.col("status") == FAILED), FAILED).otherwise(OK).alias("status"),
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
    )


def lost_values(outcomes: DataFrame) -> DataFrame:
    """Rows, and values that did not fit their column's type, per trip file name and column."""
    named = outcomes.where(F.col("status") == OK)
    lost = named.select("source_file", F.explode("n_lost").alias("column_name", "n_lost"))
    lost = lost.groupBy("source_file", "column_name").agg(F.sum("n_lost").alias("n_lost"))
    rows = named.groupBy("source_file").agg(F.sum("n_rows").alias("n_rows"))
    return lost.join(rows, "source_file")


def success_rate(outcomes: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "ok")
    total = F.count(F.lit(1))
    return outcomes.agg(
        total.alias("n_entries"),
        ok.alias("n_ok"),
        (total - ok).alias("n_failed"),
        F.round(F.try_divide(ok * F.lit(100.0), total), 1).alias("success_rate_pct"),
    )
