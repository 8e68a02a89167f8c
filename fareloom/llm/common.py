"""What the text operators share: tables, batches of texts, worker code, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20  # texts that a worker holds as Python objects at once
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and whole texts of all documents."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{ROOT}" if paths else ROOT


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{name}-{uuid4().hex[:12]}"


_open_steps: list[list[str]] = []  # paths written inside `steps`, the innermost last


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Cut the lineage: the rows, as a table in the shared folder, or a folder of it
    for each value of the last column, if that is `by`."""
    path = shared_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    if _open_steps:
        _open_steps[-1].append(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what `written` leaves inside, but for the tables that are kept.

    What is kept has to be read from tables alone; then nothing is needed of the
    steps before it. After an error the tables stay.
    """
    paths: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.written_to)
        return df

    _open_steps.append(paths)
    try:
        yield keep
    finally:
        _open_steps.pop()
    for path in paths:
        if path not in kept:
            delete(spark, path)
    if _open_steps:
        _open_steps[-1].extend(kept)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).delete(folder, True)


MAY_BE = "__may_be"
_FILTER_BITS = 1 << 25
_BITMAP = 1 << 15  # bits that one of Spark's bitmaps has


def may_be(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Add `MAY_BE`: false only if a row's key (bigint) is none of the wanted ones.

    `wanted` has one column. Its keys are hashed into bitmaps, 4 MB in all however
    many there are, so rows are told apart where they lie; a row that only seems
    wanted is left to the join that follows. Null keys are not wanted.
    """
    bit = F.pmod(F.xxhash64(F.col(wanted.columns[0])), F.lit(_FILTER_BITS)) + 1
    bits = wanted.where(F.col(wanted.columns[0]).isNotNull()).select(bit.alias("__bit"))
    maps = bits.groupBy(F.bitmap_bucket_number("__bit").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__map")
    )
    own = F.pmod(F.xxhash64(F.col(key)), F.lit(_FILTER_BITS)) + 1
    placed = df.withColumns(
        {"__at": F.bitmap_bucket_number(own), "__place": F.bitmap_bit_position(own)}
    )
    # At most a thousand bitmaps of 4 kB, so the broadcast is bounded.
    both = placed.join(F.broadcast(maps), F.col("__at") == F.col("__bucket"), "left")
    byte = "CAST(conv(hex(substring(__map, CAST(__place div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    there = F.expr(f"shiftright({byte}, CAST(__place % 8 AS INT)) & 1 = 1")
    there = F.coalesce(there & F.col(key).isNotNull(), F.lit(False))
    return both.withColumn(MAY_BE, there).drop("__at", "__place", "__bucket", "__map")


def vocabulary_path(name: str) -> str:
    """Where a tokenizer's file is: a path as it is, or the name of a public one."""
    return name if "/" in name else public_tokenizers.path(name)


def held_out(modulus: int, remainder: int = 2) -> Column:
    """Rows that nothing is learnt from; a null id is one of them."""
    found = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(found == remainder, F.lit(True))


def batches(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """UTF-8 texts in runs of about `limit` bytes; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    run, size = [], 0
    for value in texts.cast(kind):
        text = value.as_py() or b""
        run.append(text)
        size += len(text)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def decoded(texts: pa.Array) -> list[str]:
    """Texts, bytes that are no UTF-8 replaced; a null is an empty text."""
    return [(value.as_py() or b"").decode("utf-8", "replace") for value in texts.cast(pa.binary())]


def utf8(text: bytes) -> bytes:
    """A text as valid UTF-8, bytes that are none replaced."""
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()
    return text


def struct_array(columns: dict[str, Sequence], types: dict[str, pa.DataType]) -> pa.Array:
    arrays = [pa.array(columns[name], kind) for name, kind in types.items()]
    return pa.StructArray.from_arrays(arrays, names=list(types))
