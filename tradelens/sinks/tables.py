"""Staging tables: a catalog table or a Parquet folder, created with a declared schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import clean_schema_name


def create_namespace(spark: SparkSession, name: str) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` with the cleaned name; returns the name."""
    db = clean_schema_name(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    return db


# Partition folders cannot tell an empty text from a missing value; the empty text of a
# partition column is stored as this marker and read back as ''.
EMPTY_PARTITION = "__EMPTY__"


def ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


@dataclass
class StagingTable:
    """A staging table addressed by catalog name or by a Parquet folder.

    Rows are appended only (single writer per table); ``partition_by`` columns
    become folders, so loads restricted to a few dates read only those folders.
    ``bucket_by=(column, n)`` (catalog tables) hashes rows into ``n`` buckets per
    partition: an aggregate or distinct count keyed by that column then reads the
    buckets without shuffling the stored history.
    """

    spark: SparkSession
    name: str | None = None
    path: str | None = None
    schema: T.StructType | None = None
    partition_by: list[str] = field(default_factory=list)
    bucket_by: tuple[str, int] | None = None

    def __post_init__(self):
        if (self.name is None) == (self.path is None):
            raise ValueError("give exactly one of name or path")
        if self.bucket_by is not None and self.name is None:
            raise ValueError("bucketing needs a catalog table (name)")

    @property
    def namespace(self) -> str | None:
        """The database of a catalog table."""
        return self.name.rpartition(".")[0] or None if self.name is not None else None

    def _swap_empty(self, df: DataFrame, old: str, new: str) -> DataFrame:
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        return df.withColumns({c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c))
                               for c in self.partition_by if c in texts})

    @property
    def label(self) -> str:
        return self.name or self.path

    def exists(self) -> bool:
        if self.name is not None:
            return self.spark.catalog.tableExists(self.name)
        return path_exists(self.spark, self.path)

    def ensure(self, schema: T.StructType | None = None) -> bool:
        """Create the empty table with the declared schema if absent; True if created."""
        schema = schema or self.schema
        if self.exists():
            return False
        if schema is None:
            raise ValueError(f"no schema to create {self.label}")
        if self.name is not None:
            parts = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
            if self.bucket_by is not None:
                col, n = self.bucket_by
                parts += f" CLUSTERED BY ({col}) INTO {int(n)} BUCKETS"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({ddl_columns(schema)}) USING parquet{parts}")
        else:
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)
        return True

    def read(self) -> DataFrame:
        """Current rows; the file listing is refreshed first (appends by other jobs)."""
        if self.name is not None:
            self.spark.catalog.refreshTable(self.name)
            return self._swap_empty(self.spark.table(self.name), EMPTY_PARTITION, "")
        reader = self.spark.read
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return self._swap_empty(reader.parquet(self.path), EMPTY_PARTITION, "")

    def append(self, df: DataFrame, observation: Observation | None = None) -> None:
        """Append ``df``; ``observation`` (a row count ``n``) is taken in the writing stage."""
        def observed(out: DataFrame) -> DataFrame:
            return out if observation is None else out.observe(observation, F.count(F.lit(1)).alias("n"))
        df = self._swap_empty(df, "", EMPTY_PARTITION)
        if self.name is not None:
            out = df.select(*self.spark.table(self.name).columns)
            if self.bucket_by is not None:
                # Same hash as the bucket id: each task writes one bucket file per partition.
                out = out.repartition(int(self.bucket_by[1]), self.bucket_by[0])
            else:
                out = self._rebalanced(out)
            observed(out).write.mode("append").insertInto(self.name)
        else:
            observed(self._rebalanced(df)).write.mode("append").partitionBy(*self.partition_by).parquet(self.path)

    def _rebalanced(self, df: DataFrame) -> DataFrame:
        """Rows of a partition folder meet in as many tasks as their bytes need (AQE splits and
        merges by the advisory size), so files follow the data, not tasks times folders."""
        return df.hint("rebalance", *self.partition_by) if self.partition_by else df.hint("rebalance")

    def drop(self) -> None:
        if self.name is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, asked of the cluster file system (HDFS, object stores,
    local) through Hadoop's FileSystem API.  Where no JVM gateway exists (Spark
    Connect), creating a reader on the folder is the probe (a missing folder fails
    analysis)."""
    try:
        jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem via the gateway
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))  # noqa: SLF001
    except AttributeError:
        try:
            spark.read.format("parquet").schema("id string").load(path)
            return True
        except AnalysisException:
            return False


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder, sorted; none if it does not exist."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()) if fs.exists(hpath) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the cluster's file system, if it exists."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)  # noqa: SLF001


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    """Development reset: drop the named staging tables (opt-in)."""
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
