"""The layers: raw to bronze to silver to gold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import BOUNDS, FLEET, FLEETS, MONTH, PARTITIONING, YEAR, Bound, Fleet
from fareloom.labels import PORTUGUESE, LabelSet
from fareloom.operators.derive import add_categories, add_time_columns, impute_passengers
from fareloom.operators.quality import applicable, bronze_rules, judge, keep_rows, silver_rules
from fareloom.operators.rollup import hourly_rollup
from fareloom.operators.unify import (
    fill_missing,
    merge_native_columns,
    project_contract,
    standardize,
    union_all,
)
from fareloom.sinks.journal import Journal
from fareloom.sinks.quarantine import divide
from fareloom.sinks.sketches import SKETCHES, build
from fareloom.sinks.tables import Lake, WriteReport
from fareloom.sinks.zones import file_path, remember, rows_of, zones

RAW_PARTITIONING = (FLEET, "year_month")  # as trip files are delivered


def unify(frames: Mapping[str, DataFrame], extra=()) -> DataFrame:
    """One canonical frame from the fleets' own frames, keyed by fleet name."""
    return union_all(
        standardize(frame, FLEETS.get(name, Fleet(name)), extra) for name, frame in frames.items()
    )


def unify_mixed(raw: DataFrame, extra=()) -> DataFrame:
    """One canonical frame from a raw table that holds all fleets' columns."""
    return project_contract(fill_missing(merge_native_columns(raw)), extra)


@dataclass(frozen=True)
class Layers:
    """The layer transformations under one set of bounds and labels."""

    bounds: Mapping[str, Bound] = None
    labels: LabelSet = PORTUGUESE

    def __post_init__(self):
        object.__setattr__(self, "bounds", {**BOUNDS, **(self.bounds or {})})

    def bronze(self, unified: DataFrame) -> DataFrame:
        """Clean rows with their pickup parts and duration."""
        return add_time_columns(keep_rows(unified, bronze_rules(self.bounds)), self.labels)

    def silver(self, bronze: DataFrame) -> DataFrame:
        """Plausible trips, passengers imputed, with their categories."""
        rules = applicable(silver_rules(self.bounds), bronze)
        return add_categories(impute_passengers(keep_rows(bronze, rules)), self.labels)

    def judged_bronze(self, unified: DataFrame) -> DataFrame:
        """All rows with their pickup parts, and the reasons of those bronze rejects."""
        rules = bronze_rules(self.bounds)
        return add_time_columns(judge(unified, rules), self.labels)

    def judged_silver(self, bronze: DataFrame) -> DataFrame:
        """All rows as silver would have them, and the reasons of those it rejects."""
        rules = applicable(silver_rules(self.bounds), bronze)
        return add_categories(impute_passengers(judge(bronze, rules)), self.labels)

    def gold(self, silver: DataFrame) -> DataFrame:
        return hourly_rollup(silver, self.labels)

    def gold_from(self, unified: DataFrame) -> DataFrame:
        """Gold straight from unified trips, as one scan and one shuffle."""
        return self.gold(self.silver(self.bronze(unified)))


def refresh(
    lake: Lake,
    raw: DataFrame,
    layers: Layers | None = None,
    by_month: bool = True,
    quarantine: bool = False,
) -> dict[str, WriteReport]:
    """Write all four layers, each from the table below it.

    `by_month` says that the raw files follow fleet and month, as delivered
    files do. Bronze is then written without a shuffle; the few trips that are
    in the wrong file make small files, which `maintain` collects. Silver takes
    over the layout of bronze and never needs a shuffle. With `quarantine`, rows
    that bronze and silver reject are kept beside them, with the reasons.
    """
    layers = layers or Layers()
    reports = {"raw": lake.write("raw", raw, RAW_PARTITIONING)}
    remember(lake, _raw_zones(lake.read("raw")), RAW_PARTITIONING)
    unified = unify_mixed(lake.read("raw"))
    if quarantine:
        reports |= divide(lake, "bronze", layers.judged_bronze(unified), not by_month)
        reports |= divide(lake, "silver", layers.judged_silver(lake.read("bronze")))
    else:
        bronze = layers.bronze(unified)
        reports["bronze"] = lake.write("bronze", bronze, PARTITIONING, rebalance=not by_month)
        reports["silver"] = lake.write("silver", layers.silver(lake.read("bronze")), PARTITIONING)
    reports["gold"] = lake.write("gold", layers.gold(lake.read("silver")))
    Journal(lake).done()
    return reports


def refresh_partitions(
    lake: Lake, new_raw: DataFrame, layers: Layers | None = None
) -> dict[str, WriteReport | None]:
    """Bring all layers up to date with some trip files, new or delivered again.

    `new_raw` has all rows of its fleets' months, which take the place of what
    raw has of them. Above raw, only those months of pickup are computed anew
    that trips of the new files, or of the ones they replace, belong to, and only
    they are written; trips in a wrong month's file are found by their pickup.
    Of raw, only files are read whose zone meets these months. Gold, a few
    thousand cells a year, takes over its other months.

    The months are stored as an intent before raw changes. If the job dies, at
    whatever step, the same call once more, or `finish_refresh` if raw was
    replaced already, brings the layers to where they should be.
    """
    layers = layers or Layers()
    journal = Journal(lake)
    # One record per fleet and month: what the catalogue holds too.
    touched = journal.pending()

    def intend(path: str) -> None:
        stored = lake.stored("raw", path)
        months = stored.select(*RAW_PARTITIONING).distinct()
        replaced = lake.read("raw").join(months, list(RAW_PARTITIONING), "left_semi")
        for rows in (stored, replaced):
            found = layers.bronze(unify_mixed(rows)).select(*PARTITIONING).distinct()
            touched.update(tuple(row) for row in found.collect())
        journal.intend(touched)

    reports: dict[str, WriteReport | None] = {}
    reports["raw"] = lake.write_partitions("raw", new_raw, before=intend)
    remember(lake, _raw_zones(lake.stored("raw", reports["raw"].path)), RAW_PARTITIONING)
    return reports | _rebuild(lake, layers, touched)


def finish_refresh(lake: Lake, layers: Layers | None = None) -> dict[str, WriteReport | None]:
    """Bring the layers above raw up to date after a refresh that died behind raw."""
    return _rebuild(lake, layers or Layers(), Journal(lake).pending())


def _raw_zones(raw: DataFrame) -> DataFrame:
    keys = list(RAW_PARTITIONING)
    return zones(unify_mixed(raw.withColumn("path", file_path()), extra=("path",)), *keys)


def _rebuild(lake: Lake, layers: Layers, touched: set) -> dict[str, WriteReport | None]:
    """Compute the touched months of all layers above raw, and end the intent."""
    keys = list(PARTITIONING)
    reports: dict[str, WriteReport | None] = {}
    if touched:
        raw = rows_of(lake, touched)
        for layer, rows in (
            ("bronze", lambda: _of_months(layers.bronze(unify_mixed(raw)), touched)),
            ("silver", lambda: layers.silver(_of_months(lake.read("bronze"), touched))),
        ):
            reports[layer] = lake.write_partitions(layer, rows())
            left = {
                (fleet, int(year), int(month))
                for fleet, year, month in lake.partitions_below(layer, reports[layer].path)
            }
            lake.drop_partitions(layer, sorted(touched - left))
        wanted = _of_months(lake.read("silver"), touched)
        kept = lake.read("gold").join(_months(lake, touched), keys, "left_anti")
        gold = kept.unionByName(layers.gold(wanted))
        reports["gold"] = lake.write("gold", gold.select(*lake.read("gold").columns))
        if lake.has(SKETCHES):
            build(lake, "silver", touched)
    Journal(lake).done()
    return reports


def _months(lake_or_frame, touched) -> DataFrame:
    spark = getattr(lake_or_frame, "spark", None) or lake_or_frame.sparkSession
    return spark.createDataFrame(
        sorted(touched), f"{FLEET} string, {YEAR} int, {MONTH} int"
    )


def _of_months(frame: DataFrame, touched) -> DataFrame:
    """Rows of some fleets' months: partitions are pruned by year and month."""
    years, months = ({t[i] for t in touched} for i in (1, 2))
    near = frame.where(F.col(YEAR).isin(*years) & F.col(MONTH).isin(*months))
    return near.join(_months(frame, touched), list(PARTITIONING), "left_semi")


def maintain(lake: Lake) -> dict[str, dict[str, int]]:
    """Compact every layer where it has small files, and analyse it."""
    statistics = {}
    for layer in lake.existing():
        lake.compact(layer)
        statistics[layer] = lake.analyze(layer)
    return statistics
