"""Columns whose type differs from file to file: one type for all, and what it costs.

Types form a lattice. Whole numbers widen to longer ones and to fractions, dates
to timestamps, and whatever has nothing in common to text. A contract column has
the contract's type whatever the files say. A value that its column's type cannot
hold becomes null and is counted: text that is no number, a fraction where a
whole number belongs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")
FRACTIONS = ("float", "double")
TIMES = ("timestamp", "timestamp_ntz")
PLAIN = (*WHOLE, *FRACTIONS, *TIMES, "date", "boolean", "string")  # types that text can be read as


def is_number(kind: str) -> bool:
    return kind in WHOLE or kind in FRACTIONS or kind.startswith("decimal")


def wider(one: str, other: str) -> str:
    """The least type that holds the values of both."""
    if one == other:
        return one
    if one in WHOLE and other in WHOLE:
        return max(one, other, key=WHOLE.index)
    if is_number(one) and is_number(other):
        return "double"
    times = {kind for kind in (one, other) if kind in TIMES}
    if "date" in (one, other) and len(times) == 1:
        return times.pop()
    return "string"


def promoted(schemas: Iterable[Mapping[str, str]]) -> dict[str, str]:
    """One type per column over schemas of column name to type."""
    found: dict[str, str] = {}
    for schema in schemas:
        for name, kind in schema.items():
            found[name] = wider(found.get(name, kind), kind)
    return found


def is_exact(kind: str, wanted: str) -> bool:
    """Whether every value of a type has its like in the wanted one."""
    zoned_or_not = kind in TIMES and wanted in TIMES
    return zoned_or_not or wanted == "string" or wider(kind, wanted) == wanted


def as_type(value: str, kind: str, wanted: str) -> str:
    """SQL for a value in the wanted type; null if the type cannot hold it.

    Zoned and zoneless timestamps both pass as they are: a cast between them
    would move trips across a daylight saving change.
    """
    if kind == wanted or (kind in TIMES and wanted in TIMES):
        return value
    if is_exact(kind, wanted):
        return f"CAST({value} AS {wanted})"
    if is_number(kind) and is_number(wanted):
        cast = f"try_cast({value} AS {wanted})"
        return f"IF({value} = {cast}, {cast}, NULL)"
    if kind == "string" and (wanted in PLAIN or is_number(wanted)):
        return f"try_cast({value} AS {wanted})"
    return f"CAST(NULL AS {wanted})"


def losses(df: DataFrame, wanted: Mapping[str, str], *keys) -> DataFrame | None:
    """Values lost per key and column that has any; None if no column can lose one.

    One scan, of the columns that need another type only.
    """
    own = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    drifting = {
        name: as_type(f"`{name}`", own[name.lower()], kind)
        for name, kind in wanted.items()
        if name.lower() in own and not is_exact(own[name.lower()], kind)
    }
    if not drifting:
        return None
    counts = df.groupBy(*keys).agg(
        *(F.expr(f"count_if(`{n}` IS NOT NULL AND ({sql}) IS NULL)").alias(n) for n, sql in drifting.items())
    )
    pairs = F.map_from_arrays(
        F.array(*map(F.lit, drifting)), F.array(*(F.col(f"`{name}`") for name in drifting))
    )
    names = [name for name in counts.columns if name not in drifting]
    lost = counts.select(*names, F.explode(pairs).alias("column_name", "n_lost"))
    return lost.where("n_lost > 0")
