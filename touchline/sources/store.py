"""Where staging and mart tables live: a folder of Parquet tables or a database.

A table is replaced in two steps. ``prepare`` writes the rows under a new name,
which may be read and checked; ``publish`` gives them the table's name without
moving data. A write that fails leaves the old rows as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.checks import check_distinct_names

# Errors of a read that mean that there is no table, or only leftovers of a write.
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
#: The partition column of tables that loads append to.
LOAD_ID = "load_id"
# Properties of a view: the version that it reads, and the one it read before.
CURRENT, PREVIOUS = "touchline.current", "touchline.previous"


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str]) -> DataFrameWriter:
    check_distinct_names(df.columns)
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _fresh(name: str) -> str:
    return f"{name}__{uuid.uuid4().hex}"


def _of_load(df: DataFrame, load_id: str) -> DataFrame:
    """The rows with their load as the last column."""
    if not load_id[:1].isalpha():
        # The ids are names of folders, and Spark reads those that look like numbers or dates
        # as such.
        raise ValueError(f"a load id must start with a letter, not {load_id!r}")
    if not load_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a load id has letters, digits, - and _ only, not {load_id!r}")
    if LOAD_ID in (name.lower() for name in df.columns):
        raise ValueError(f"the column {LOAD_ID} is kept for the store")
    return df.withColumn(LOAD_ID, F.lit(load_id))


def fingerprint_of_files(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of all files below a path as one short text.

    Spark lists them and combines their hashes; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("hash"), F.sum("length").alias("size")).first()
    return f"{row['n']} files, {row['size'] or 0} bytes, {row['hash'] or 0}"


def _write_load(rows: DataFrame, path: str) -> None:
    """Replace the partitions that the rows are of, and no others.

    Files are written to a staging folder of the write's own and moved at its end. So a write
    that fails leaves an earlier try as it is, and writes side by side don't meet.
    """
    writer = _writer(rows, "overwrite", [LOAD_ID]).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


class Replacing:
    """What both kinds of store do with ``prepare``, ``publish`` and ``discard``."""

    def write(
        self, df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
    ) -> None:
        """Replace a table, or append to it."""
        if mode == "append":
            self.append(df, name, partition_by)
        elif mode == "overwrite":
            self.publish(df.sparkSession, self.prepare(df, name, partition_by), name)
        else:
            raise ValueError(f"mode {mode} is neither overwrite nor append")

    def files(self, spark: SparkSession, name: str) -> DataFrame:
        """The table in a form that tells the files of its rows."""
        return self.read(spark, name)

    def read_load(self, spark: SparkSession, name: str, load_id: str) -> DataFrame:
        """The rows that one load appended; only their files are read."""
        return self.files(spark, name).filter(F.col(LOAD_ID) == load_id)


@dataclass(frozen=True)
class PathStore(Replacing):
    """Parquet tables in a folder of shared storage.

    ``publish`` renames twice, the old table aside and the new one into its place. Between
    the two there is no table for readers, for as long as a rename takes. If the driver is
    lost there, the next write to the table, or ``recover``, puts the old one back. Where that
    gap matters, use a CatalogStore. Renames need Hadoop's file system, which a Spark Connect
    session does not offer.
    """

    root: str

    def location(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        """The table; a known schema saves the look into its files."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self.location(name))

    def exists(self, spark: SparkSession, name: str) -> bool:
        try:
            self.read(spark, name)
        except AnalysisException as error:
            if error.getCondition() not in NO_TABLE:
                raise
            return False
        return True

    def version(self, spark: SparkSession, name: str) -> str:
        """A text that changes when the table's files do."""
        return fingerprint_of_files(spark, self.location(name)) if self.exists(spark, name) else ""

    def _file_system(self, spark: SparkSession, name: str):  # noqa: ANN202
        path = spark._jvm.org.apache.hadoop.fs.Path(self.location(name))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _rename(self, spark: SparkSession, old: str, new: str) -> bool:
        files, source = self._file_system(spark, old)
        return files.rename(source, self._file_system(spark, new)[1])

    def _there(self, spark: SparkSession, name: str) -> bool:
        files, path = self._file_system(spark, name)
        return files.exists(path)

    @staticmethod
    def _aside(name: str) -> str:
        return f"{name}__aside"

    def recover(self, spark: SparkSession, name: str) -> bool:
        """Put a table back that a lost driver left aside; whether there was one to put back."""
        aside = self._aside(name)
        if not self._there(spark, aside):
            return False
        if self._there(spark, name):
            self.discard(spark, aside)
            return False
        if not self._rename(spark, aside, name):
            raise OSError(f"{self.location(aside)} cannot be moved back")
        return True

    def prepare(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write the rows beside the table and return the new name; a failure leaves none."""
        self.recover(df.sparkSession, name)
        new = _fresh(name)
        try:
            _writer(df, "errorifexists", partition_by).parquet(self.location(new))
        except BaseException:
            self.discard(df.sparkSession, new)
            raise
        return new

    def publish(self, spark: SparkSession, new: str, name: str) -> None:
        """Put prepared rows in the place of the table."""
        self.recover(spark, name)
        aside = self._aside(name)
        if self._there(spark, name) and not self._rename(spark, name, aside):
            raise OSError(f"{self.location(name)} cannot be moved aside")
        if not self._rename(spark, new, name):
            self.recover(spark, name)
            raise OSError(f"{self.location(new)} cannot be moved to its place")
        self.discard(spark, aside)
        spark.catalog.refreshByPath(self.location(name))

    def discard(self, spark: SparkSession, new: str) -> None:
        """Drop prepared rows."""
        files, path = self._file_system(spark, new)
        files.delete(path, True)

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        _writer(df, "append", partition_by).parquet(self.location(name))

    def append_load(self, df: DataFrame, name: str, load_id: str) -> None:
        """Append the rows as a partition of their own, in place of an earlier try."""
        _write_load(_of_load(df, load_id), self.location(name))

    def drop_load(self, spark: SparkSession, name: str, load_id: str) -> None:
        """Remove the rows of one load, if there are any."""
        self.discard(spark, f"{name}/{LOAD_ID}={load_id}")

    def empty(self, spark: SparkSession, *names: str) -> None:
        """Remove all rows of the tables that exist, and the leftovers of failed writes."""
        for name in names:
            if self.exists(spark, name):
                schema = self.read(spark, name).schema
                self.write(spark.createDataFrame([], schema), name)
            else:
                self.discard(spark, name)


@dataclass(frozen=True)
class CatalogStore(Replacing):
    """Tables of one database in the session's catalog.

    A table is a view over its current version, which is a table of its own. ``publish`` is one
    CREATE OR REPLACE VIEW: a reader sees the old version or the new one, and a driver that is
    lost at any step leaves the one or the other. The version before stays until the next
    publish, for readers that have started on it. A version that a lost driver left behind is
    dropped by ``sweep``. A plain table of that name, made by others, is renamed to a version
    when it is first replaced; only that one time there is a moment without a table.
    """

    database: str

    def location(self, name: str) -> str:
        return f"{self.database}.{name}"

    def read(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        """The table, with the schema that the catalog holds."""
        return spark.table(self.location(name))

    def files(self, spark: SparkSession, name: str) -> DataFrame:
        """The current version itself; a view doesn't tell files."""
        return spark.table(self.location(self.versions(spark, name)[0]))

    def exists(self, spark: SparkSession, name: str) -> bool:
        return spark.catalog.tableExists(self.location(name))

    def versions(self, spark: SparkSession, name: str) -> tuple[str, str]:
        """The tables that the view reads and read before; the name itself for a plain table."""
        if not self.exists(spark, name):
            return "", ""
        if spark.catalog.getTable(self.location(name)).tableType != "VIEW":
            return name, ""
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {self.location(name)}").collect()}
        return found.get(CURRENT, ""), found.get(PREVIOUS, "")

    def version(self, spark: SparkSession, name: str) -> str:
        """A text that changes when the table is replaced or its files change."""
        current, _ = self.versions(spark, name)
        if not current:
            return ""
        return f"{current}, {fingerprint_of_files(spark, self._place(spark, current))}"

    def _partitions(self, spark: SparkSession, name: str) -> list[str]:
        return [c.name for c in spark.catalog.listColumns(self.location(name)) if c.isPartition]

    def prepare(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write the rows as a new version and return its name; a failure leaves none."""
        new = _fresh(name)
        try:
            self._save(df, new, "errorifexists", partition_by)
        except BaseException:
            self.discard(df.sparkSession, new)
            raise
        return new

    def publish(self, spark: SparkSession, new: str, name: str) -> None:
        """Let the table's name stand for a prepared version, in one step."""
        current, previous = self.versions(spark, name)
        if current == name:
            current = _fresh(name)
            spark.sql(f"ALTER TABLE {self.location(name)} RENAME TO {self.location(current)}")
            if self._partitions(spark, current):
                # The catalog still has the partitions at the places they were written to.
                spark.catalog.recoverPartitions(self.location(current))
        spark.sql(
            f"CREATE OR REPLACE VIEW {self.location(name)} "
            f"TBLPROPERTIES ('{CURRENT}' = '{new}', '{PREVIOUS}' = '{current}') "
            f"AS SELECT * FROM {self.location(new)}"
        )
        if previous:
            self.discard(spark, previous)

    def discard(self, spark: SparkSession, new: str) -> None:
        """Drop a prepared version, or a published table with its versions."""
        current, previous = self.versions(spark, new)
        if current in ("", new):
            spark.sql(f"DROP TABLE IF EXISTS {self.location(new)}")
            return
        spark.sql(f"DROP VIEW IF EXISTS {self.location(new)}")
        for version in filter(None, (current, previous)):
            spark.sql(f"DROP TABLE IF EXISTS {self.location(version)}")

    def sweep(self, spark: SparkSession, name: str) -> list[str]:
        """Drop versions that no view reads or has just read, as lost drivers leave them.

        Not while the table is being loaded: a version that is prepared is one of them.
        """
        kept = self.versions(spark, name)
        found = [t.name for t in spark.catalog.listTables(self.database, f"{name}__*")]
        left = [x for x in found if x not in kept and x.removeprefix(f"{name}__").isalnum()]
        for version in left:
            self.discard(spark, version)
        return left

    def _open(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> str:
        """The version to append to; an empty one is published if there is no table."""
        spark = df.sparkSession
        if not self.exists(spark, name):
            # Not of ``df`` itself, whose rows may be observed on their way to the table.
            none = spark.createDataFrame([], df.schema)
            self.publish(spark, self.prepare(none, name, partition_by), name)
        return self.versions(spark, name)[0]

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        self._save(df, self._open(df, name, partition_by), "append", partition_by)

    def _place(self, spark: SparkSession, version: str) -> str:
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {self.location(version)}")
        return told.filter("col_name = 'Location'").first()["data_type"]

    def append_load(self, df: DataFrame, name: str, load_id: str) -> None:
        """Append the rows as a partition of their own, in place of an earlier try.

        The table must be there before loads run side by side.
        """
        spark, rows = df.sparkSession, _of_load(df, load_id)
        version = self._open(rows, name, [LOAD_ID])
        _write_load(rows, self._place(spark, version))
        table = self.location(version)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({LOAD_ID} = '{load_id}')")
        spark.catalog.refreshTable(table)

    def drop_load(self, spark: SparkSession, name: str, load_id: str) -> None:
        """Remove the rows of one load, if there are any."""
        version = self.location(self.versions(spark, name)[0])
        spark.sql(f"ALTER TABLE {version} DROP IF EXISTS PARTITION ({LOAD_ID} = '{load_id}')")

    def _save(self, df: DataFrame, name: str, mode: str, partition_by: Sequence[str]) -> None:
        writer = _writer(df, mode, partition_by).format("parquet")
        writer.saveAsTable(self.location(name))

    def empty(self, spark: SparkSession, *names: str) -> None:
        """Replace the tables that exist by versions without rows."""
        for name in names:
            if self.exists(spark, name):
                parts = self._partitions(spark, self.versions(spark, name)[0])
                none = spark.createDataFrame([], self.read(spark, name).schema)
                self.write(none, name, partition_by=parts)


Store = PathStore | CatalogStore
