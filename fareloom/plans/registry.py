"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.contract import (
    AMOUNT,
    DISTANCE,
    DROPOFF,
    DURATION,
    FLEET,
    FLEETS,
    GREEN,
    HOUR,
    MONTH,
    PARTITIONING,
    PASSENGERS,
    PICKUP,
    VENDOR,
    WEEKDAY,
    YEAR,
    YELLOW,
)
from fareloom.functions import bands, calendar
from fareloom.labels import ENGLISH, PORTUGUESE
from fareloom.operators import profile, quality, unify
from fareloom.operators.derive import add_categories, add_time_columns, impute_passengers
from fareloom.operators.distribution import distribution, group_quantiles
from fareloom.operators.zorder import as_number
from fareloom.plans import answers
from fareloom.plans.medallion import Layers, finish_refresh, refresh, refresh_partitions
from fareloom.plans.medallion import unify as unify_fleets
from fareloom.session import fresh_path
from fareloom.sinks.hashes import changed_rows, differences, snapshot
from fareloom.sinks.quarantine import rejects
from fareloom.sinks.sketches import RANK_ERROR, SKETCHES, build, estimates
from fareloom.sinks.tables import Lake
from fareloom.sinks.zones import file_path, rows_of
from fareloom.sources import landing
from fareloom.sources.events import fleet_frame, line_trips, read_events, trips

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = answers.Period(2024, 5)
ID = "event_id"
LAYERS = Layers()
_written: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, build):
    """Build something written to the shared folder once per application."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = build()
    return _written[key]


# Stages over the trip view of `events`.


def fleet_frames(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: fleet_frame(spark, sf_dir, fleet) for name, fleet in FLEETS.items()}


def tagged_frames(spark, sf_dir) -> dict[str, DataFrame]:
    frames = fleet_frames(spark, sf_dir)
    return {name: frame.withColumn(FLEET, F.lit(name)) for name, frame in frames.items()}


def bronze(spark, sf_dir) -> DataFrame:
    return LAYERS.bronze(trips(spark, sf_dir))


def silver(spark, sf_dir) -> DataFrame:
    return LAYERS.silver(bronze(spark, sf_dir))


def gold(spark, sf_dir) -> DataFrame:
    return LAYERS.gold(silver(spark, sf_dir))


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Cut the last bits of floating sums, which depend on the order of adding."""
    names = [name for name, kind in frame.dtypes if kind == "double"]
    return frame.withColumns({name: F.round(name, digits) for name in names})


# Trip files. One folder per fleet and month, as if delivered by a producer.


def _deliver(frame: DataFrame, fleet: str, base: str, folder: str) -> None:
    """Write a fleet's trips as monthly files."""
    pickup = FLEETS[fleet].native([PICKUP])[0]
    month = calendar.year_month(F.year(pickup), F.month(pickup))
    entry = F.concat(F.lit(f"{fleet}_tripdata_"), month, F.lit(landing.SUFFIX))
    files = frame.withColumn("entry", entry).hint("rebalance", "entry")
    files.write.partitionBy("entry").parquet(f"{base}/{folder}")


def plain_folder(spark: SparkSession, sf_dir: str) -> str:
    """Monthly files with the same column types in all files of a fleet."""

    def build() -> str:
        base = fresh_path(spark, "plain")
        for name, frame in fleet_frames(spark, sf_dir).items():
            _deliver(frame, name, base, name)
        return base

    return _once("plain", spark, sf_dir, build)


# Months that a producer delivered as text, with these words for what it did not know.
DRIFTING = {
    YELLOW.name: (4, {AMOUNT: "n/a"}),
    GREEN.name: (2, {PASSENGERS: "unknown", DROPOFF: "no time"}),
}


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """Monthly files of each fleet: a month of either has columns as text, vendor
    numbers as fractions, and one more file is no Parquet."""

    def build() -> str:
        base = fresh_path(spark, "landing")
        for name, frame in fleet_frames(spark, sf_dir).items():
            month, words = DRIFTING[name]
            pickup = FLEETS[name].native([PICKUP])[0]
            drifts = F.month(pickup) == month
            _deliver(frame.where(~drifts | F.col(pickup).isNull()), name, base, name)
            native = dict(zip(FLEETS[name].native(words), words.values(), strict=True))
            text = {c: F.coalesce(F.col(c).cast("string"), F.lit(w)) for c, w in native.items()}
            text[VENDOR] = F.col(VENDOR).cast("double")
            _deliver(frame.where(drifts).withColumns(text), name, base, f"{name}-as-text")
        broken = f"{base}/damaged/entry=green_tripdata_2024-06{landing.SUFFIX}"
        read_events(spark, sf_dir).select("props").write.text(broken)
        return base

    return _once("landing", spark, sf_dir, build)


def ingested(spark: SparkSession, sf_dir: str) -> landing.Ingest:
    def build() -> landing.Ingest:
        entries = landing.landing_entries(spark, landing_folder(spark, sf_dir))
        return landing.ingest(spark, entries)

    return _once("ingest", spark, sf_dir, build)


def scan_parquet(spark, sf_dir):
    """The plain scan of both fleets' files, under their own column names."""
    base = plain_folder(spark, sf_dir)
    fleets = [spark.read.parquet(f"{base}/{name}") for name in FLEETS]
    return unify.union_all([frame.drop("entry") for frame in fleets])


def ingest_multi_source(spark, sf_dir):
    outcomes = landing.outcome_frame(spark, ingested(spark, sf_dir).outcomes)
    return landing.entry_outcomes(outcomes).select(
        "source_file", FLEET, "year_month", "status", "n_rows"
    )


def ingest_success_rate(spark, sf_dir):
    result = ingested(spark, sf_dir)
    outcomes = landing.outcome_frame(spark, result.outcomes)
    return landing.success_rate(landing.entry_outcomes(outcomes))


def ingest_type_drift(spark, sf_dir):
    """Values per file and column that were no number or time where one belongs."""
    outcomes = landing.outcome_frame(spark, ingested(spark, sf_dir).outcomes)
    return landing.lost_values(outcomes)


def provenance_columns(spark, sf_dir):
    return ingested(spark, sf_dir).raw.select(
        ID,
        FLEET,
        "year_month",
        "source_file",
        F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_time"),
    )


def file_name_parse(spark, sf_dir):
    files = ingested(spark, sf_dir).raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    parsed = landing.parse_name(F.col("source_file"))
    return files.select(
        "source_file", *(value.alias(name) for name, value in parsed.items()), "n_rows"
    )


def text_deliveries(spark: SparkSession, sf_dir: str) -> str:
    """Every trip's event as a line of uncompressed text, in a folder per trip file."""

    def build() -> str:
        base = fresh_path(spark, "deliveries")
        line = F.concat_ws(",", ID, FLEET, VENDOR).alias("line")
        entry = F.col("source_file").alias("entry")
        lines = trips(spark, sf_dir).select(entry, line).hint("rebalance", "entry")
        lines.write.partitionBy("entry").option("compression", "none").text(base)
        return base

    return _once("deliveries", spark, sf_dir, build)


def manifest_sizes(spark, sf_dir):
    entries = landing.manifest(landing.list_files(spark, text_deliveries(spark, sf_dir)))
    return entries.select("source_file", FLEET, "year_month", "n_bytes", "size_mb")


def manifest_total(spark, sf_dir):
    entries = landing.manifest(landing.list_files(spark, text_deliveries(spark, sf_dir)))
    return landing.manifest_total(entries).select("n_entries", "total_mb")


def manifest_missing(spark, sf_dir):
    """Files that January to July should have and the folder does not."""
    present = landing.manifest(landing.list_files(spark, landing_folder(spark, sf_dir)))
    expected = landing.expected_entries(spark, list(FLEETS), "2024-01", "2024-07")
    return landing.missing_entries(expected, present)


# Layer tables.


def scratch_lake(spark: SparkSession, prefix: str) -> Lake:
    """A lake of its own under the session's shared folder."""
    path = fresh_path(spark, prefix)
    return Lake(spark, path.rpartition("/")[2].replace("-", "_"), path).create()


def layer_tables(spark: SparkSession, sf_dir: str) -> Lake:
    """All four layers as tables, refreshed from the trip files."""

    def build() -> Lake:
        lake = scratch_lake(spark, "trips")
        refresh(lake, ingested(spark, sf_dir).raw.drop(ID))
        return lake

    return _once("layers", spark, sf_dir, build)


def layer_read(spark, sf_dir):
    return rounded(layer_tables(spark, sf_dir).read("gold"))


def layer_counts(spark, sf_dir):
    return layer_tables(spark, sf_dir).counts()


def table_stats(spark, sf_dir):
    lake = layer_tables(spark, sf_dir)
    stats = [(layer, lake.analyze(layer)["rows"]) for layer in lake.existing()]
    return spark.createDataFrame(stats, "layer string, n_rows bigint")


def gold_sample(spark, sf_dir):
    return rounded(answers.sample(layer_tables(spark, sf_dir).read("gold")))


def _numbered(spark, sf_dir) -> DataFrame:
    """Silver trips with their id, for tables written by a single query."""
    return silver(spark, sf_dir).select(ID, *PARTITIONING, PICKUP, AMOUNT, PASSENGERS, DURATION)


def write_roundtrip(spark, sf_dir):
    """Write twice, the second time from the table itself, and read back."""
    lake = scratch_lake(spark, "roundtrip")
    lake.write("silver", _numbered(spark, sf_dir))
    lake.write("silver", lake.read("silver"))
    return lake.read("silver")


def _by_partition(table: DataFrame) -> DataFrame:
    return table.groupBy(*PARTITIONING).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(AMOUNT), 2).alias("revenue")
    )


def write_partitioned(spark, sf_dir):
    """Write by partition, then replace one month by twice its amounts."""
    lake = scratch_lake(spark, "partitioned")
    lake.write("silver", _numbered(spark, sf_dir), PARTITIONING, rebalance=True)
    month = lake.read("silver").filter(F.col(MONTH) == PERIOD.month)
    lake.write_partitions("silver", month.withColumn(AMOUNT, F.col(AMOUNT) * 2))
    return _by_partition(lake.read("silver"))


def schema_merge(spark, sf_dir):
    """Older partitions lack the fare column that a later write brings."""
    lake = scratch_lake(spark, "merged")
    table = trips(spark, sf_dir).select(ID, AMOUNT, FLEET, "fare_amount")
    lake.write("silver", table.drop("fare_amount"), [FLEET], rebalance=True)
    lake.write_partitions("silver", table.where(F.col(FLEET) == GREEN.name))
    return lake.read("silver").select(ID, AMOUNT, "fare_amount")


def refresh_new_files(spark, sf_dir):
    """Gold after new and redelivered files came to layers that stood already."""
    lake = scratch_lake(spark, "incremental")
    raw = ingested(spark, sf_dir).raw
    late = F.col("year_month") >= "2024-05"
    again = F.col("year_month") == "2024-03"
    refresh(lake, raw.where(~late).where(~again | (F.col(ID) % 2 == 0)).drop(ID))
    refresh_partitions(lake, raw.where(late | again).drop(ID))
    return rounded(lake.read("gold"))


def refresh_after_death(spark, sf_dir):
    """The same, but the first attempt dies when raw has been replaced."""
    lake = scratch_lake(spark, "interrupted")
    raw = ingested(spark, sf_dir).raw
    again = F.col("year_month") == "2024-03"
    refresh(lake, raw.where(~again | (F.col(ID) % 2 == 0)).drop(ID))
    dying = Layers()
    object.__setattr__(dying, "silver", None)  # bronze is written, silver cannot be
    try:
        refresh_partitions(lake, raw.where(again).drop(ID), dying)
    except TypeError:
        finish_refresh(lake)
    return rounded(lake.read("gold"))


def refresh_one_month(spark, sf_dir):
    """Raw files read to refresh one month, out of all of them."""
    lake = layer_tables(spark, sf_dir)
    month = [(name, PERIOD.year, PERIOD.month) for name in FLEETS]
    rows = rows_of(lake, month)
    all_files = lake.files("raw").groupBy(FLEET).agg(F.count(F.lit(1)).alias("all_files"))
    read = rows.select(FLEET, file_path().alias("path")).distinct().groupBy(FLEET).agg(
        F.count(F.lit(1)).alias("files_read")
    )
    pickup = (F.year(PICKUP) == PERIOD.year) & (F.month(PICKUP) == PERIOD.month)
    trips_found = rows.where(pickup).groupBy(FLEET).agg(F.count(F.lit(1)).alias("n_rows"))
    return trips_found.join(read, FLEET).join(all_files, FLEET).select(
        FLEET, "n_rows", (F.col("files_read") * 3 <= F.col("all_files")).alias("few_files")
    )


def quarantine_write(spark, sf_dir):
    """Rows kept and rejected by bronze and silver, per partition and reasons."""
    lake = scratch_lake(spark, "quarantine")
    refresh(lake, ingested(spark, sf_dir).raw.drop(ID), quarantine=True)
    parts = []
    for layer in ("bronze", "silver"):
        kept = lake.read(layer).withColumn("reasons", F.lit("kept"))
        gone = lake.read(rejects(layer))
        gone = gone.withColumn("reasons", F.array_join(quality.REASONS, "+"))
        for rows in (kept, gone):
            counted = rows.groupBy(*PARTITIONING, "reasons").agg(F.count(F.lit(1)).alias("n_rows"))
            parts.append(counted.withColumn("layer", F.lit(layer)))
    return unify.union_all(parts)


def compact_table(spark, sf_dir):
    """Scatter a table over one file per core and partition, then compact it."""
    lake = scratch_lake(spark, "compacted")
    scattered = _numbered(spark, sf_dir).repartition(
        max(2, spark.sparkContext.defaultParallelism)
    )
    reports = (lake.write("silver", scattered, PARTITIONING), lake.compact("silver"))
    before, after = (
        spark.read.parquet(report.path)
        .groupBy(FLEET, F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(FLEET)
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias(files))
        for report, files in zip(reports, ("files_before", "files_after"), strict=True)
    )
    return after.join(before.drop("n_rows"), FLEET).select(
        FLEET, "n_rows", (F.col("files_after") < F.col("files_before")).alias("fewer_files")
    )


def clustered_write(spark, sf_dir):
    """Cluster a table by pickup and count the files whose ranges overlap."""
    lake = scratch_lake(spark, "clustered")
    lake.write("silver", _numbered(spark, sf_dir), PARTITIONING)
    lake.cluster("silver", PICKUP, target_bytes=max(1, lake.size("silver") // 16))
    files = (
        lake.read("silver")
        .groupBy(*PARTITIONING, F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.min(PICKUP).alias("first"), F.max(PICKUP).alias("last")
        )
    )
    in_order = Window.partitionBy(*PARTITIONING).orderBy("first", "last")
    overlap = F.col("first") < F.lag("last").over(in_order)
    return (
        files.withColumn("overlaps", F.coalesce(overlap, F.lit(False)))
        .groupBy(*PARTITIONING)
        .agg(F.sum("n").alias("n_rows"), F.count_if("overlaps").alias("overlapping_files"))
    )


def zorder_write(spark, sf_dir):
    """Z-order a table by pickup and amount; either column alone skips files."""
    lake = scratch_lake(spark, "zordered")
    lake.write("silver", _numbered(spark, sf_dir))
    lake.zorder("silver", PICKUP, AMOUNT, target_bytes=max(1, lake.size("silver") // 64))
    table = lake.read("silver").withColumn("file", file_path())
    reports = []
    for name in (PICKUP, AMOUNT):
        # A fiftieth of the rows, from the middle of the column.
        value = as_number(lake.read("silver"), name)
        low, high = lake.read("silver").select(value.alias("v")).approxQuantile("v", [0.5, 0.52], 0.001)
        in_file = table.groupBy("file").agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("most")
        )
        met = (F.col("least") <= high) & (F.col("most") >= low)
        reports.append(
            in_file.agg(
                F.sum("n").alias("n_rows"),
                (F.count_if(met) * 2 < F.count(F.lit(1))).alias("skips_half"),
            ).withColumn("column_name", F.lit(name))
        )
    return unify.union_all(reports)


def hash_tree_diff(spark, sf_dir):
    """Rows changed in one month, found by descending a hash tree."""
    lake = scratch_lake(spark, "hashed")
    lake.write("silver", _numbered(spark, sf_dir), PARTITIONING, rebalance=True)
    before = snapshot(lake, "silver")
    month = lake.read("silver").where(F.col(MONTH) == PERIOD.month)
    raised = F.when(F.col(ID) % 50 == 3, F.col(AMOUNT) + 1).otherwise(F.col(AMOUNT))
    lake.write_partitions("silver", month.withColumn(AMOUNT, raised))
    after = snapshot(lake, "silver", before)
    files = differences(spark, before, after, PARTITIONING)
    return changed_rows(lake, "silver", files).select(
        *PARTITIONING, ID, "side", F.round(AMOUNT, 6).alias(AMOUNT)
    )


def dq_sketches(spark, sf_dir):
    """Quantiles from merged sketches of partitions, and whether their ranks are near."""
    lake = layer_tables(spark, sf_dir)
    build(lake)
    per_mille = [250, 500, 750, 950]
    found = estimates(lake.read(SKETCHES), per_mille)
    rows = lake.read("silver")
    reports = []
    for row in found.collect():  # one row per column
        value = F.col(row["metric"])
        for share, estimate in zip(per_mille, row["quantiles"], strict=True):
            below, upto = F.count_if(value < estimate), F.count_if(value <= estimate)
            slack = F.count(value) * RANK_ERROR
            near = (below <= F.count(value) * share / 1000 + slack) & (
                upto >= F.count(value) * share / 1000 - slack
            )
            report = rows.agg(F.count(value).alias("n_values"), near.alias("near"))
            known = F.lit(row["n_values"]) == F.col("n_values")
            reports.append(
                report.select(
                    F.lit(row["metric"]).alias("metric"), F.lit(share).alias("per_mille"),
                    "n_values", (F.col("near") & known).alias("within_bound"),
                )
            )
    return unify.union_all(reports)


# Schema unification.


def union_sources(spark, sf_dir):
    unified = unify_fleets(tagged_frames(spark, sf_dir), extra=(ID,))
    return unified.select(ID, FLEET, VENDOR, AMOUNT, PICKUP, DROPOFF, DISTANCE, "fare_amount")


def standardize_schema(spark, sf_dir):
    """Each fleet's frame in the contract's form, and both together."""
    frames = tagged_frames(spark, sf_dir)
    return unify.union_all(
        unify.standardize(frame, FLEETS[name], extra=(ID,)) for name, frame in frames.items()
    )


def split_rename_union(spark, sf_dir):
    """Trips of a raw table with both fleets' timestamp columns in it."""
    mixed = unify.union_all(tagged_frames(spark, sf_dir).values())
    merged = unify.merge_native_columns(mixed)
    return merged.select(ID, FLEET, PICKUP, DROPOFF)


def fill_missing_columns(spark, sf_dir):
    """Sources without passenger count and dropoff get both as nulls."""
    source = trips(spark, sf_dir).drop(PASSENGERS, DROPOFF)
    return unify.fill_missing(source).select(ID, VENDOR, PASSENGERS, AMOUNT, PICKUP, DROPOFF)


def project_contract(spark, sf_dir):
    """Columns outside the contract go; absent optional ones stay away."""
    source = unify.merge_native_columns(unify.union_all(tagged_frames(spark, sf_dir).values()))
    source = source.drop(ID).withColumn("unknown_extra", F.lit(1))
    return unify.project_contract(source)


def contract_check(spark, sf_dir):
    frames = fleet_frames(spark, sf_dir)
    frames[GREEN.name] = frames[GREEN.name].drop(PASSENGERS)
    return unify.contract_check(frames)


def distinct_sources(spark, sf_dir):
    return unify.distinct_fleets(trips(spark, sf_dir))


# Row rules.


def _kept(rules: Callable[[], list[quality.Rule]], spark, sf_dir) -> DataFrame:
    source = quality.with_duration(trips(spark, sf_dir))
    return quality.keep_rows(source, rules()).select(ID, FLEET, AMOUNT, PASSENGERS, DURATION)


def _one_rule(name: str) -> Callable[[], list[quality.Rule]]:
    return lambda: [rule for rule in quality.bronze_rules() if rule.name == name]


def silver_rules(spark, sf_dir):
    kept = quality.keep_rows(bronze(spark, sf_dir), quality.silver_rules())
    return kept.select(ID, AMOUNT, DISTANCE, DURATION)


def rules_declared(spark, sf_dir):
    """Trips that meet every declared bound."""
    kept = quality.keep_rows(trips(spark, sf_dir), quality.declared_rules())
    return kept.select(ID, PASSENGERS, AMOUNT, DISTANCE)


def all_rules() -> list[quality.Rule]:
    return quality.bronze_rules() + quality.silver_rules()


# Derived columns.


def _derived(columns: Callable[[], dict[str, Column]], spark, sf_dir) -> DataFrame:
    source = trips(spark, sf_dir)
    return source.select(ID, *(value.alias(name) for name, value in columns().items()))


def bronze_derive(spark, sf_dir):
    return add_time_columns(trips(spark, sf_dir)).select(
        ID, YEAR, MONTH, HOUR, WEEKDAY, "pickup_dayname", "pickup_period", DURATION
    )


def imputed(spark, sf_dir):
    return impute_passengers(bronze(spark, sf_dir)).select(ID, PASSENGERS)


def silver_enrich(spark, sf_dir):
    return add_categories(bronze(spark, sf_dir)).select(
        ID, "is_weekend", "fare_category", "passenger_category"
    )


def line_rollup(spark, sf_dir):
    """The hourly rollup over order lines, as a second and larger source."""
    unified = line_trips(spark, sf_dir)
    return LAYERS.gold_from(unified)


def _answer(name: str, spark, sf_dir) -> DataFrame:
    return answers.answer(gold(spark, sf_dir), name, PERIOD)


def _answers() -> dict[str, Query]:
    queries = {name: partial(_answer, name) for name in answers.catalogue(PERIOD)}
    queries["explore_gold"] = lambda s, d: rounded(_answer("explore_gold", s, d))
    del queries["gold_sample"]  # read from the table instead
    return queries


def all_queries() -> dict[str, Query]:
    hour, weekday = (lambda: F.hour(PICKUP)), (lambda: F.dayofweek(PICKUP))
    return {
        # sources
        "scan_parquet": scan_parquet,
        "ingest_multi_source": ingest_multi_source,
        "provenance_columns": provenance_columns,
        "file_name_parse": file_name_parse,
        "manifest_sizes": manifest_sizes,
        "manifest_total": manifest_total,
        "manifest_missing": manifest_missing,
        "ingest_success_rate": ingest_success_rate,
        "ingest_type_drift": ingest_type_drift,
        "layer_read": layer_read,
        "layer_counts": layer_counts,
        # sinks
        "write_roundtrip": write_roundtrip,
        "write_partitioned": write_partitioned,
        "schema_merge": schema_merge,
        "compact_table": compact_table,
        "clustered_write": clustered_write,
        "table_stats": table_stats,
        "gold_sample": gold_sample,
        "refresh_new_files": refresh_new_files,
        "refresh_after_death": refresh_after_death,
        "refresh_one_month": refresh_one_month,
        "quarantine_write": quarantine_write,
        "zorder_write": zorder_write,
        "hash_tree_diff": hash_tree_diff,
        # unification
        "union_sources": union_sources,
        "standardize_schema": standardize_schema,
        "split_rename_union": split_rename_union,
        "fill_missing_columns": fill_missing_columns,
        "project_contract": project_contract,
        "contract_check": contract_check,
        "distinct_sources": distinct_sources,
        # row rules
        "clean_not_null": partial(_kept, _one_rule("not_null")),
        "clean_non_negative": partial(_kept, _one_rule("non_negative")),
        "clean_time_order": partial(_kept, _one_rule("time_order")),
        "clean_passenger_range": partial(_kept, _one_rule("passenger_range")),
        "bronze_clean": partial(_kept, quality.bronze_rules),
        "silver_rules": silver_rules,
        "rules_declared": rules_declared,
        # derived columns
        "date_parts": partial(_derived, lambda: calendar.date_parts(F.col(PICKUP))),
        "day_name": partial(
            _derived,
            lambda: {
                "pickup_dayname": calendar.day_name(weekday(), PORTUGUESE),
                "day_name_en": calendar.day_name(weekday(), ENGLISH),
            },
        ),
        "day_period": partial(
            _derived,
            lambda: {
                "pickup_period": calendar.day_period(hour(), PORTUGUESE),
                "period_en": calendar.day_period(hour(), ENGLISH),
            },
        ),
        "trip_duration": partial(
            _derived,
            lambda: {DURATION: calendar.minutes_between(F.col(PICKUP), F.col(DROPOFF))},
        ),
        "year_month_label": partial(
            _derived,
            lambda: {"year_month": calendar.year_month(F.year(PICKUP), F.month(PICKUP))},
        ),
        "weekend_flag": partial(
            _derived, lambda: {"is_weekend": calendar.is_weekend(weekday())}
        ),
        "fare_band": partial(
            _derived, lambda: {"fare_category": bands.fare_band(F.col(AMOUNT), PORTUGUESE)}
        ),
        "party_size": partial(
            _derived,
            lambda: {"passenger_category": bands.party_size(F.col(PASSENGERS), PORTUGUESE)},
        ),
        "demand_band": partial(
            _derived, lambda: {"demand_period": bands.demand_band(hour(), ENGLISH)}
        ),
        "impute_passengers": imputed,
        "bronze_derive": bronze_derive,
        "silver_enrich": silver_enrich,
        # rollup and answers
        "gold_rollup": lambda s, d: rounded(gold(s, d)),
        "gold_rollup_lines": lambda s, d: rounded(line_rollup(s, d)),
        "monthly_evolution_lines": lambda s, d: answers.monthly_evolution(line_rollup(s, d)),
        **_answers(),
        "q1_detail_raw": lambda s, d: answers.fleet_mean_from_trips(bronze(s, d)),
        "q2_hour_raw": lambda s, d: answers.passengers_from_trips(bronze(s, d), PERIOD.text),
        # profiling
        "dq_null_rate": lambda s, d: profile.null_rates(
            trips(s, d), [VENDOR, PASSENGERS, AMOUNT, PICKUP, DROPOFF, DISTANCE, "fare_amount"]
        ),
        "dq_outliers": lambda s, d: profile.outliers(trips(s, d)),
        "dq_time_order": lambda s, d: profile.time_consistency(trips(s, d), FLEET),
        "dq_ranges": lambda s, d: profile.range_validity(trips(s, d)),
        "dq_report": lambda s, d: profile.rule_report(
            quality.with_duration(trips(s, d)), all_rules()
        ),
        "dq_reject_reasons": lambda s, d: profile.reject_reasons(
            quality.with_duration(trips(s, d)), all_rules(), FLEET
        ),
        "dq_checksum": lambda s, d: profile.checksum(
            trips(s, d).drop("ingestion_timestamp"), FLEET, "year_month"
        ),
        "dq_group_quantiles": lambda s, d: rounded(
            group_quantiles(silver(s, d), [AMOUNT, DISTANCE, DURATION], [FLEET, MONTH], [500, 950])
        ),
        "dq_sketches": dq_sketches,
        "dq_distribution": lambda s, d: rounded(
            distribution(silver(s, d), [AMOUNT, DISTANCE, DURATION])
        ),
    }

