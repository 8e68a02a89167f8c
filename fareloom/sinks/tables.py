"""Layer tables: write, read back, compact, cluster, count and analyse."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from math import ceil
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.contract import LAYER_TABLES, SIDE_TABLES
from fareloom.operators.unify import union_all
from fareloom.operators.zorder import with_z

TARGET_FILE_BYTES = 512 * 1024 * 1024
SMALL_SHARE = 4  # a file below a fourth of the target is small
SHUFFLE_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SCAN_BYTES, SCAN_TASKS = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
VERSION = "v-"  # fixed value: how the names of folders begin that the lake writes
PER_STATEMENT = 100  # partitions that one change of the catalogue adds
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for null


@dataclass(frozen=True)
class WriteReport:
    table: str
    path: str
    rows: int


@dataclass(frozen=True)
class Lake:
    """The layer tables of one schema.

    Tables are external Parquet below the lake's location. Every write goes to a
    fresh folder there, and the table or its partitions are pointed to it when
    it is complete, by changing their location. A job that dies half way leaves
    the table, each partition of it old or new and complete, readers keep the
    files they opened, and a table may be rewritten from itself. Only if columns
    change their type, or the partitioning changes, is a table made anew; then
    `recover` finishes what a job that died left undone.

    Columns are only ever added: older rows have nulls in them.
    """

    spark: SparkSession
    schema: str
    location: str
    tables: dict[str, str] = field(default_factory=lambda: dict(LAYER_TABLES))
    beside: dict[str, str] = field(default_factory=lambda: dict(SIDE_TABLES))

    def create(self) -> Lake:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema}` LOCATION '{self.location}'")
        return self

    def use(self) -> None:
        """Make the schema the current one, for SQL with bare table names."""
        self.spark.sql(f"USE `{self.schema}`")

    def name(self, layer: str) -> str:
        """Table name of a layer, or of a table beside them; others are an error."""
        known = self.tables | self.beside
        if layer not in known:
            raise KeyError(f"unknown layer {layer!r}, expected one of {sorted(known)}")
        return known[layer]

    def table(self, layer: str) -> str:
        """Qualified table name of a layer."""
        return f"`{self.schema}`.`{self.name(layer)}`"

    def root(self, layer: str) -> str:
        """The folder that all data of a layer lies below."""
        return f"{self.location.rstrip('/')}/{self.name(layer)}"

    def read(self, layer: str) -> DataFrame:
        return self.spark.table(self.table(layer))

    def partitioning(self, layer: str) -> list[str]:
        # The catalogue's name parser takes the parts without quotes.
        columns = self.spark.catalog.listColumns(self.table(layer).replace("`", ""))
        return [column.name for column in columns if column.isPartition]

    def write(
        self, layer: str, df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = False
    ) -> WriteReport:
        """Replace a layer. The row count comes out of the write itself.

        With `rebalance`, rows are shuffled to their partitions first, and
        adaptive execution splits a partition too big for one task and joins
        small ones. It is for input not laid out by those columns; input that
        is, such as the layer below, needs no shuffle.
        """
        if rebalance and partition_by:
            df = df.hint("rebalance", *partition_by)
        return self._replace(layer, df, partition_by)

    def write_partitions(
        self, layer: str, df: DataFrame, before: Callable[[str], None] | None = None
    ) -> WriteReport:
        """Replace only those partitions of a layer that `df` has rows for.

        New columns are added to the table, and columns that `df` lacks are null.
        `before` is called with the folder that the rows are stored in, while the
        table still has its old ones.
        """
        keys, known = self.partitioning(layer), self.read(layer).schema
        present = {name.lower() for name in df.columns}
        fitting = df.select(
            *(
                (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in known
            ),
            *(name for name in df.columns if name.lower() not in {f.name.lower() for f in known}),
        )
        path, rows = self._store(layer, fitting, keys)
        if before:
            before(path)
        self._add_columns(layer, fitting.schema)
        self._point_partitions(layer, keys, path)
        return WriteReport(self.table(layer), path, rows)

    def partitions_below(self, layer: str, path: str) -> list[tuple]:
        """Values of the partitions that a write stored in a folder, as text or None."""
        return [values for values, _ in self._folders(self.partitioning(layer), path)]

    def drop_partitions(self, layer: str, values: Sequence[Sequence]) -> None:
        """Take partitions, given by their values, out of a layer."""
        keys = self.partitioning(layer)
        for value in values:
            texts = [None if v is None else str(v) for v in value]
            self.spark.sql(f"ALTER TABLE {self.table(layer)} DROP IF EXISTS {self._spec(keys, texts)}")
        self.spark.catalog.refreshTable(self.table(layer))

    def compact(
        self, layer: str, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int | None = None
    ) -> WriteReport | None:
        """Rewrite the partitions with two or more small files; None if none has.

        A file is small below `small_bytes`, by default a fourth of the target.
        Rows are shuffled to their partitions, and adaptive execution cuts the
        shuffle by the target size: a big partition goes to many tasks, small
        ones share a task. A layer without partitions is looked at as a whole,
        and needs no shuffle: its files are packed into scan tasks of that size.
        Sizes are set in a session of its own.
        """
        keys = self.partitioning(layer)
        limit = small_bytes or max(1, target_bytes // SMALL_SHARE)
        small = self.files(layer).where(F.col("length") < limit)
        chosen = small.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if chosen.isEmpty():
            return None
        if not keys:
            packed = self._apart({SCAN_BYTES: target_bytes, SCAN_TASKS: 1})
            report = packed._replace(layer, packed.read(layer), keys)
            self.spark.catalog.refreshTable(self.table(layer))
            return report
        apart = self._apart({SHUFFLE_BYTES: target_bytes})
        # As many records as partitions have small files, as in the catalogue.
        values = [row.asDict() for row in chosen.select(*keys).collect()]
        rows = apart.read(layer)
        for key in keys:  # prunes partitions; the join below chooses among the rest
            some = {value[key] for value in values}
            known = F.col(key).isin(*(v for v in some if v is not None))
            rows = rows.where(known | F.col(key).isNull() if None in some else known)
        wanted = apart.spark.createDataFrame(values, rows.select(*keys).schema)
        same = [rows[key].eqNullSafe(wanted[key]) for key in keys]
        rows = rows.join(wanted, same, "left_semi")
        path, count = apart._store(layer, rows.hint("rebalance", *keys), keys)
        self._point_partitions(layer, keys, path)
        return WriteReport(self.table(layer), path, count)

    def cluster(self, layer: str, *order: str, target_bytes: int = TARGET_FILE_BYTES) -> WriteReport:
        """Rewrite a layer so that files hold disjoint ranges of `order`.

        The ranges run over partition columns first, so a file belongs to few
        partitions and a big partition is split by `order`. Range bounds come
        from a sample, which keeps a hot partition from landing in one task.
        """
        keys = self.partitioning(layer)
        files = max(1, ceil(self.size(layer) / target_bytes))
        ranged = self.read(layer).repartitionByRange(files, *keys, *order)
        return self._replace(layer, ranged.sortWithinPartitions(*keys, *order), keys)

    def zorder(self, layer: str, *columns: str, target_bytes: int = TARGET_FILE_BYTES) -> WriteReport:
        """Rewrite a layer so that files hold small ranges of each of some columns.

        The ranges run over partition columns first, then over the columns' z-value,
        so a filter on any of them skips files. Bounds of ranks and ranges come from
        sketches and samples; equal values share a rank.
        """
        keys = self.partitioning(layer)
        files = max(1, ceil(self.size(layer) / target_bytes))
        valued = with_z(self.read(layer), columns, "__z")
        ranged = valued.repartitionByRange(files, *keys, "__z")
        return self._replace(layer, ranged.sortWithinPartitions(*keys, "__z").drop("__z"), keys)

    def files(self, layer: str) -> DataFrame:
        """Data files of a layer with partition values and size; no column is read."""
        file = F.col("_metadata")
        return self.read(layer).select(
            *self.partitioning(layer),
            file["file_path"].alias("path"),
            file["file_size"].alias("length"),
        ).distinct()

    def size(self, layer: str) -> int:
        """Bytes of a layer's data files."""
        return self.files(layer).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]

    def expire(self, layer: str) -> list[str]:
        """Delete folders that the lake wrote for a layer and that it uses no more.

        Readers that began before the last write may still read them, and a write
        that goes on has a folder too, so this is for a time without either.
        Returns the folders deleted.
        """
        written = self.versions(layer)
        pattern = f"/{self.name(layer)}/({VERSION}[0-9a-f]+)/"
        version = F.regexp_extract("path", pattern, 1)
        sharing = [layer, *(other for other in (f"{layer}_rejects",) if other in self.beside)]
        used = {
            row[0]
            for other in sharing
            if self.has(other)
            for row in self.files(other).select(version).distinct().collect()
        }
        used |= set(written[-1:])  # it may have no rows
        old = [name for name in written if name not in used]
        paths = [f"{self.root(layer)}/{name}" for name in old]
        for path in paths:
            delete_folder(self.spark, path)
        return paths

    def versions(self, layer: str) -> list[str]:
        """Names of the folders that were written for a layer, the oldest first."""
        folders = folders_below(self.spark, self.root(layer))
        return [name for name in folders if name.startswith(VERSION)]

    def stored(self, layer: str, path: str) -> DataFrame:
        """What a write of a layer stored, with the table's columns."""
        return self.spark.read.schema(self.read(layer).schema).parquet(path)

    def analyze(self, layer: str) -> dict[str, int]:
        """Compute table statistics and return them."""
        table = self.table(layer)
        self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        detail = self.spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'")
        return {
            unit: int(number)
            for number, unit in (part.split() for part in detail.first()["data_type"].split(", "))
        }

    def existing(self) -> list[str]:
        """Layers whose table exists."""
        present = {t.name for t in self.spark.catalog.listTables(self.schema)}
        return [layer for layer, table in self.tables.items() if table in present]

    def counts(self) -> DataFrame:
        """Rows per existing layer; Parquet answers this from file footers."""
        layers = self.existing()
        return union_all(
            self.read(layer).agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(layer).alias("layer"),
                F.lit(self.tables[layer]).alias("table_name"),
                "n_rows",
                F.lit("gold" in layers).alias("gold_ready"),
            )
            for layer in layers
        )

    def recover(self, layer: str) -> None:
        """Finish the exchange of tables that a job left half way."""
        names = {t.name for t in self.spark.catalog.listTables(self.schema)}
        name = self.name(layer)
        if f"{name}__coming" in names:
            coming = f"`{self.schema}`.`{name}__coming`"
            if name not in names:
                self.spark.sql(f"ALTER TABLE {coming} RENAME TO {self.table(layer)}")
            else:
                self.spark.sql(f"DROP TABLE {coming}")

    def _apart(self, settings: dict[str, int]) -> Lake:
        """The same lake in a session of its own, with the settings of this one and some more."""
        session = self.spark.newSession()
        for name, value in self.spark.conf.getAll.items():
            if session.conf.isModifiable(name):
                session.conf.set(name, value)
        for name, value in settings.items():
            session.conf.set(name, str(value))
        return Lake(session, self.schema, self.location, self.tables, self.beside)

    def _replace(self, layer: str, df: DataFrame, keys: Sequence[str]) -> WriteReport:
        path, rows = self._store(layer, df, keys)
        return self.adopt(layer, df.schema, keys, path, rows)

    def adopt(
        self, layer: str, schema: StructType, keys: Sequence[str], path: str, rows: int
    ) -> WriteReport:
        """Let a layer stand for what a write stored in a folder, and for nothing else."""
        self.recover(layer)
        if not self._fits(layer, schema, keys):
            self._make(layer, schema, keys, path)
        else:
            self._add_columns(layer, schema)
            if keys:
                self._point_partitions(layer, keys, path, all_of_them=True)
            else:
                self.spark.sql(f"ALTER TABLE {self.table(layer)} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(self.table(layer))
        return WriteReport(self.table(layer), path, rows)

    def _store(self, layer: str, df: DataFrame, keys: Sequence[str]) -> tuple[str, int]:
        path, counts = self.store(layer, df, keys)
        return path, counts["rows"]

    def store(
        self, layer: str, df: DataFrame, keys: Sequence[str], **counts: Column
    ) -> tuple[str, dict[str, int]]:
        """Write to a fresh folder of the lake, which no table stands for yet.

        Returns the folder, and the rows and further `counts` taken on the way.
        """
        path = f"{self.root(layer)}/{VERSION}{uuid4().hex[:12]}"
        counted = Observation()
        more = (value.alias(name) for name, value in counts.items())
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows"), *more).write
        (writer.partitionBy(*keys) if keys else writer).parquet(path)
        return path, counted.get

    def has(self, layer: str) -> bool:
        """Whether the table of a layer exists."""
        return self.spark.catalog.tableExists(f"{self.schema}.{self.name(layer)}")

    def _fits(self, layer: str, schema: StructType, keys: Sequence[str]) -> bool:
        """Whether a table can take these columns by adding some."""
        if not self.has(layer) or self.partitioning(layer) != list(keys):
            return False
        known = {f.name.lower(): f.dataType for f in self.read(layer).schema}
        return all(known.get(f.name.lower(), f.dataType) == f.dataType for f in schema)

    def _add_columns(self, layer: str, schema: StructType) -> None:
        known = {name.lower() for name in self.read(layer).columns}
        new = [f for f in schema if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.table(layer)} ADD COLUMNS ({columns})")

    def _make(self, layer: str, schema: StructType, keys: Sequence[str], path: str) -> None:
        """A new table for the files below a folder, complete before it has its name."""
        table, coming = self.table(layer), f"`{self.schema}`.`{self.name(layer)}__coming`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        partitioned = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        self.spark.sql(
            f"CREATE TABLE {coming} ({columns}) USING parquet {partitioned} LOCATION '{path}'"
        )
        if keys:
            self._point_partitions(layer, keys, path, table=coming)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(f"ALTER TABLE {coming} RENAME TO {table}")

    def _folders(self, keys: Sequence[str], path: str) -> list[tuple[tuple, str]]:
        """Partition values, as text or None, and folder of what a write left.

        Values are read from the folders' names as they stand, never guessed.
        """
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = listing.option("pathGlobFilter", "*.parquet").load(path)
        folder = F.regexp_replace("path", "/[^/]+$", "").alias("folder")
        found = []
        for row in files.select(folder).distinct().orderBy("folder").collect():
            parts = dict(part.split("=", 1) for part in row["folder"].rsplit("/", len(keys))[1:])
            texts = (unquote(parts[quote(key)] if quote(key) in parts else parts[key]) for key in keys)
            found.append((tuple(None if t == NO_VALUE else t for t in texts), row["folder"]))
        return found

    def _point_partitions(
        self,
        layer: str,
        keys: Sequence[str],
        path: str,
        table: str | None = None,
        all_of_them: bool = False,
    ) -> None:
        """Make the partitions written below a folder stand for those of the table;
        with `all_of_them`, other partitions go."""
        table = table or self.table(layer)
        folders = dict(self._folders(keys, path))
        present = self._partitions(table, keys, folders)
        new = [
            f"{self._spec(keys, values)} LOCATION {_literal(folder)}"
            for values, folder in folders.items()
            if values not in present
        ]
        for start in range(0, len(new), PER_STATEMENT):
            some = " ".join(new[start : start + PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
        for values in present & folders.keys():
            partition, location = self._spec(keys, values), _literal(folders[values])
            self.spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION {location}")
        if all_of_them:
            for values in present - folders.keys():
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {self._spec(keys, values)}")
        self.spark.catalog.refreshTable(table)

    def _partitions(self, table: str, keys: Sequence[str], coming) -> set[tuple]:
        """Values of a table's partitions; the catalogue says null as text, which is
        taken for the value only if that one is coming."""
        found = set()
        for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            parts = dict(part.split("=", 1) for part in row["partition"].split("/"))
            texts = tuple(unquote(parts[key]) for key in keys)
            values = tuple(None if t in (NO_VALUE, "null") else t for t in texts)
            found.add(texts if texts in coming else values)
        return found

    @staticmethod
    def _spec(keys: Sequence[str], values: Sequence[str | None]) -> str:
        pairs = (
            f"`{key}` = {'NULL' if value is None else _literal(value)}"
            for key, value in zip(keys, values, strict=True)
        )
        return f"PARTITION ({', '.join(pairs)})"


def _literal(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _folder(spark: SparkSession, path: str):
    """A path and the file system it lies in."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def folders_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, the oldest first; none if it is not there."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    found = [f for f in system.listStatus(folder) if f.isDirectory()]
    found = [(f.getModificationTime(), f.getPath().getName()) for f in found]
    return [name for _, name in sorted(found)]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write of Spark to a folder came to its end."""
    system, marker = _folder(spark, f"{path}/_SUCCESS")
    return system.exists(marker)


def plain_path(path: str) -> str:
    """A path without what differs between Spark's ways of writing it."""
    return unquote(path).replace("///", "/", 1)


def spellings(path: str) -> list[str]:
    """The ways in which Spark may write a file's path; a filter on its path asks for them all."""
    short = path.replace("///", "/", 1)
    return sorted({path, short, unquote(path), unquote(short)})
