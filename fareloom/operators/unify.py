"""Bring the fleets' own schemas to the one contract, by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.contract import CONTRACT, FLEET, FLEETS, REQUIRED, Fleet
from fareloom.operators.drift import as_type


def conform(df: DataFrame, names: Iterable[str]) -> list[str]:
    """SQL that selects contract columns in their contract types.

    A value that its type cannot hold is null; `drift.losses` counts such values.
    """
    kinds = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    return [
        f"{as_type(f'`{name}`', kinds[name.lower()], CONTRACT[name])} AS {name}" for name in names
    ]


def rename_native(df: DataFrame, fleet: Fleet) -> DataFrame:
    """Give a fleet's columns their canonical names."""
    return df.withColumnsRenamed(dict(fleet.renames))


def fill_missing(df: DataFrame, required: Mapping[str, str] = REQUIRED) -> DataFrame:
    """Add each absent required column as a null of its contract type."""
    present = {name.lower() for name in df.columns}
    absent = [
        f"CAST(NULL AS {kind}) AS {name}"
        for name, kind in required.items()
        if name.lower() not in present
    ]
    return df.selectExpr("*", *absent) if absent else df


def project_contract(df: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Keep required columns, and optional ones that exist, in contract type.

    `extra` names further columns to keep as they are.
    """
    present = {name.lower() for name in df.columns}
    kept = [name for name in CONTRACT if name in REQUIRED or name.lower() in present]
    return df.selectExpr(*conform(df, kept), *extra)


def standardize(df: DataFrame, fleet: Fleet, extra: Iterable[str] = ()) -> DataFrame:
    """Rename, fill and project one fleet's frame."""
    return project_contract(fill_missing(rename_native(df, fleet)), extra)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name. The result does not depend on column order, and a column
    that only some frames have becomes null in the others.

    Frames are joined in pairs, then pairs of pairs: with hundreds of them, a
    chain would be analysed anew from its start at every link.
    """
    level = list(frames)
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2], strict=False)
        rest = level[-1:] if len(level) % 2 else []
        level = [left.unionByName(right, allowMissingColumns=True) for left, right in pairs] + rest
    return level[0]


def merge_native_columns(df: DataFrame, fleets: Mapping[str, Fleet] = FLEETS) -> DataFrame:
    """Resolve a frame that still holds several fleets' own columns side by side.

    Each row takes the canonical value from its own fleet's column. One pass:
    the rows are not split by fleet and put together again.
    """
    present = set(df.columns)
    sources: dict[str, list] = {}
    for fleet in fleets.values():
        for native, canonical in fleet.renames.items():
            if native in present:
                sources.setdefault(canonical, []).append((fleet.name, native))
    merged = {}
    for canonical, owners in sources.items():
        value = F.col(canonical) if canonical in present else F.lit(None)
        for name, native in owners:
            value = F.when(F.col(FLEET) == name, F.col(native)).otherwise(value)
        merged[canonical] = value
    natives = [native for owners in sources.values() for _, native in owners]
    return df.withColumns(merged).drop(*natives) if merged else df


def distinct_fleets(df: DataFrame) -> DataFrame:
    return df.select(FLEET).distinct()


def contract_gaps(columns: Iterable[str], fleet: Fleet) -> list[str]:
    """Required columns, in the fleet's own names, that a schema lacks."""
    present = {name.lower() for name in columns}
    return [name for name in fleet.native(REQUIRED) if name.lower() not in present]


def contract_check(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per fleet and required column: is it there, and how full is it?"""
    reports = []
    for name, df in frames.items():
        fleet = FLEETS.get(name, Fleet(name))
        missing = set(contract_gaps(df.columns, fleet))
        pairs = list(zip(REQUIRED, fleet.native(REQUIRED), strict=True))
        counts = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *(
                (F.lit(0).cast("bigint") if native in missing else F.count(native)).alias(native)
                for _, native in pairs
            ),
        )
        rows = [
            F.struct(
                F.lit(name).alias(FLEET),
                F.lit(canonical).alias("required_column"),
                F.lit(native).alias("native_column"),
                F.lit(native not in missing).alias("present"),
                F.col("n_rows").alias("n_rows"),
                F.col(native).alias("n_filled"),
            )
            for canonical, native in pairs
        ]
        reports.append(counts.select(F.inline(F.array(*rows))))
    return union_all(reports)

