"""Footers of Parquet files: rows, column types and damage, in one distributed pass.

Tasks open files and read their footers only, by Arrow's file systems. Files in
a store that Arrow does not know are read as a whole by Spark's binary source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_type

from fareloom.session import share_code

FILES_PER_TASK = 64
_OPENED = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
_UNSIGNED = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}
_SCHEMA = "path string, n_rows bigint, columns array<struct<name: string, kind: string>>, error string"
_COLUMNS = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string())]))


def _kind(field: pa.Field, physical: dict[str, str]) -> str:
    """A column's type as Spark calls it."""
    kind = field.type.value_type if pa.types.is_dictionary(field.type) else field.type
    if str(kind) in _UNSIGNED:
        return _UNSIGNED[str(kind)]
    if physical.get(field.name) == "INT96":
        return "timestamp"
    return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()


def _footer(source) -> tuple[int, list[dict[str, str]]]:
    with pq.ParquetFile(source) as file:
        parquet = file.metadata.schema
        columns = (parquet.column(i) for i in range(len(parquet)))
        physical = {column.path: column.physical_type for column in columns}
        kinds = [{"name": f.name, "kind": _kind(f, physical)} for f in file.schema_arrow]
        return file.metadata.num_rows, kinds


def _open(path: str):
    scheme, _, rest = path.partition(":") if urlsplit(path).scheme else ("", "", path)
    if _OPENED[scheme] == "file":
        return pyarrow.fs.LocalFileSystem().open_input_file(rest)
    uri = f"{_OPENED[scheme]}:{quote(rest, safe=':/=@%')}"
    system, inside = pyarrow.fs.FileSystem.from_uri(uri)
    return system.open_input_file(inside)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        contents = batch.column("content") if "content" in names else None
        found = []
        for i, path in enumerate(batch.column("path").to_pylist()):
            try:
                source = _open(path) if contents is None else pa.BufferReader(contents[i].as_buffer())
                found.append((path, *_footer(source), None))
            except Exception as error:  # a damaged file may raise whatever it likes
                lines = str(error).strip().splitlines() or [""]
                found.append((path, 0, [], f"{type(error).__name__}: {lines[0]}"))
        paths, rows, columns, errors = zip(*found, strict=True) if found else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(paths, pa.string()), pa.array(rows, pa.int64()),
                pa.array(columns, _COLUMNS), pa.array(errors, pa.string()),
            ],
            names=["path", "n_rows", "columns", "error"],
        )


def read_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file: its rows and columns, or the error that reading its footer raises."""
    share_code(spark)
    known = [(path,) for path in paths if urlsplit(path).scheme in _OPENED]
    other = [path for path in paths if urlsplit(path).scheme not in _OPENED]
    tasks = max(1, min(len(known), max(spark.sparkContext.defaultParallelism, len(known) // FILES_PER_TASK)))
    found = spark.createDataFrame(known, "path string").repartition(tasks).mapInArrow(_read, _SCHEMA)
    if other:
        whole = spark.read.format("binaryFile").load(other).select("path", "content")
        found = found.unionByName(whole.mapInArrow(_read, _SCHEMA))
    return found
