"""Stored tables: full-refresh snapshots, partitioned tables, and connector tables.

Files carry the data and Spark's commit protocol stages the writes. Existence checks and the
publication mark go through the Hadoop file system of the path, so every store Spark reads works.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLISHED = "_PUBLISHED"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _hadoop_path(spark, path)
    return fs.exists(hadoop)


def directories(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and paths of the directories below a path, from one listing call."""
    fs, hadoop = _hadoop_path(spark, path)
    if not fs.exists(hadoop):
        return {}
    found = [entry.getPath() for entry in fs.listStatus(hadoop) if entry.isDirectory()]
    return {entry.getName(): entry.toString() for entry in found}


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop = _hadoop_path(spark, path)
    fs.delete(hadoop, True)


def partition_name(column: str, date: str | None) -> str:
    """Directory of a date's partition; the date is given as Spark's text of it."""
    return f"{column}={NULL_PARTITION if date is None else date}"


@dataclass(frozen=True)
class SnapshotTable:
    """A table that every refresh replaces as a whole.

    Each refresh writes its own version directory and marks it published after its checks have
    passed. Readers take the newest published version, so they see the old or the new table and
    never lose files they have listed.
    """

    path: str
    partition_by: tuple[str, ...] = ()

    def stage(self, df: DataFrame) -> str:
        """Write a version that no reader sees yet."""
        version = f"{self.path}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*self.partition_by).parquet(version)
        return version

    def publish(self, spark: SparkSession, version: str) -> None:
        fs, mark = _hadoop_path(spark, f"{version}/{PUBLISHED}")
        fs.create(mark).close()

    def replace(self, df: DataFrame, check: Callable[[], object] | None = None) -> None:
        version = self.stage(df)
        if check is not None:
            check()
        self.publish(df.sparkSession, version)

    def published(self, spark: SparkSession) -> list[str]:
        """Paths of the published versions, oldest first."""
        fs, marks = _hadoop_path(spark, f"{self.path}/version=*/{PUBLISHED}")
        found = fs.globStatus(marks) or []
        return sorted(mark.getPath().getParent().toString() for mark in found)

    def current(self, spark: SparkSession) -> str | None:
        """Path of the newest published version."""
        return max(self.published(spark), default=None)

    def keep_newest(self, spark: SparkSession, count: int) -> None:
        """Delete versions beyond the newest `count` published ones; running readers may hold one.

        Staged versions older than the newest published one belong to failed refreshes and go, too.
        """
        published = self.published(spark)
        kept = {path.rpartition("/")[2] for path in published[-max(count, 1) :]}
        newest = max(kept, default="")
        for name, path in directories(spark, self.path).items():
            if name.startswith("version=") and name < newest and name not in kept:
                delete_path(spark, path)

    def read(self, spark: SparkSession) -> DataFrame:
        version = self.current(spark)
        if version is None:
            raise LookupError(f"no published version under {self.path}")
        return spark.read.parquet(version)


@dataclass(frozen=True)
class PartitionedTable:
    """A table refreshed by partition: a write replaces exactly the partitions it has rows for."""

    path: str
    schema: str
    partition_by: tuple[str, ...]

    def replace_partitions(self, df: DataFrame) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table, empty before the first write."""
        if not self.exists(spark):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.path)

    def read_slices(self, spark: SparkSession, values: Iterable[str | None]) -> DataFrame | None:
        """The partitions of the given values of the first partition column, None without any.

        Values are Spark's texts of them, as Python knows fewer dates than Spark. The table's
        directories are listed once; of the files, only those of the wanted directories are.
        """
        head = self.partition_by[0]
        wanted = {partition_name(head, value) for value in values}
        present = directories(spark, self.path)
        paths = sorted(present[name] for name in wanted & present.keys())
        if not paths:
            return None
        return spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)

    def drop(self, spark: SparkSession) -> None:
        delete_path(spark, self.path)

    def drop_slices(self, spark: SparkSession, names: Iterable[str]) -> None:
        """Deletes partitions given by their directories below the table, such as `a=1/b=2`."""
        for name in names:
            delete_path(spark, f"{self.path}/{name}")


def date_texts(dates: DataFrame) -> list[str | None]:
    """The distinct values of a frame's one date column, as Spark's texts of them."""
    texts = dates.select(F.col(dates.columns[0]).cast("string").alias("text")).distinct()
    return [row[0] for row in texts.collect()]


@dataclass(frozen=True)
class ConnectorTable:
    """A table behind a Spark data source: a warehouse connector, a table format, a catalog.

    Without a format the name is resolved by the session catalog.
    """

    name: str | None = None
    format: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        if self.format is None:
            return spark.table(self.name)
        return spark.read.format(self.format).options(**self.options).load()

    def exists(self, spark: SparkSession) -> bool:
        """Whether the table can be read; a connector says so by the class of its error."""
        if self.format is None:
            return spark.catalog.tableExists(self.name)
        try:
            self.read(spark)
        except AnalysisException:
            return False
        return True

    def replace(self, df: DataFrame, check: Callable[[], object] | None = None) -> None:
        """Full overwrite. With a check, the rows are computed and checked before they go out."""
        if check is None:
            self._write(df, "overwrite")
            return
        df = df.persist()
        try:
            df.write.format("noop").mode("overwrite").save()
            check()
            self._write(df, "overwrite")
        finally:
            df.unpersist()

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def _write(self, df: DataFrame, mode: str) -> None:
        writer = df.write.mode(mode)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.format is None:
            writer.saveAsTable(self.name)
        else:
            writer.format(self.format).options(**self.options).save()


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Before a partitioned write: few files per directory, and no task with a whole hot directory.

    The rebalance hint shuffles by the columns and lets adaptive execution split large partitions
    and merge small ones to the advisory size.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def declare(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Make a source resolvable by name in SQL and `spark.table`."""
    df.createOrReplaceTempView(name)
