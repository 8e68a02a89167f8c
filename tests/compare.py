"""Run a query in Spark and its SQL twin in DuckDB and compare the results."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name to the DuckDB types it may stand against.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(frame, db, sql):
    """Return a list of differences; empty if both sides agree exactly."""
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = normal(result.fetchall(), names)
    problems = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    for name, kind in frame.dtypes:
        if types[name] not in SAME_TYPE.get(kind, set()):
            problems.append(f"type of {name}: {kind} against {types[name]}")
    actual = normal(frame.collect(), frame.columns)
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows against {len(expected)}")
    different = [(a, e) for a, e in zip(actual, expected, strict=False) if a != e]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems
