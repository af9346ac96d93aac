"""Idempotent loads: content-hash ids and insert-if-absent.

Loading the same rows twice stores them once; rows equal in every column collapse
to one; a changed value for the same time is a new row.  One writer per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import with_row_id
from ..functions.naming import clean_columns, staging_types
from ..operators.joins import anti_join_ids
from ..session import scratch_path
from .tables import StagingTable, remove_path

@dataclass
class LoadReport:
    """``schema``: the table's namespace (None for a path table); ``source_id``: the id of the
    source query or export the rows came from, if the caller names one."""

    schema: str | None
    table_name: str
    total_rows: int            # rows fetched, duplicates included
    inserted_rows: int         # rows actually appended
    columns: list[str] = field(default_factory=list)
    source_id: str | None = None
    days: list = field(default_factory=list)   # days the batch touches, if asked for; None: no day

    def as_dict(self) -> dict:
        return {"schema": self.schema, "table_name": self.table_name, "total_rows": self.total_rows,
                "inserted_rows": self.inserted_rows, "columns": list(self.columns), "query_id": self.source_id}


def stage_rows(raw: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Clean the names, cast to staging types and put the content-hash id first."""
    return with_row_id(staging_types(clean_columns(raw)), id_cols)


def insert_new_rows(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows with ids not yet stored, one per id: a replay drops out before the deduplication,
    so it shuffles no more than the ids."""
    new = rows if existing is None else anti_join_ids(rows, existing)
    return new.dropDuplicates(["id"])


def _spans(rows: DataFrame, cols: list[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        out += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.count(F.when(F.col(c).isNull(), 1)).alias(f"null{i}")]
    return out


def _existing_ids(table: StagingTable, cols: list[str], span) -> DataFrame:
    """The stored ids that the batch could repeat.

    The id hashes every column, so an equal id has equal values: it lies between the batch's
    smallest and largest value of a column, or is null there if the batch holds nulls.  Ranges
    of the partition columns prune folders, those of others reach the scan's statistics.
    """
    stored = table.read()
    for i, c in enumerate(cols):
        near = F.lit(False) if span[f"lo{i}"] is None else F.col(c).between(span[f"lo{i}"], span[f"hi{i}"])
        stored = stored.where(near | F.col(c).isNull() if span[f"null{i}"] else near)
    return stored.select("id")


def new_rows(spark: SparkSession, rows: DataFrame, table: StagingTable,
             range_columns: tuple[str, ...] = ()) -> tuple[int, DataFrame, str]:
    """``(rows in the batch, those the table does not hold, one per id, the kept batch's folder)``.

    The caller deletes the folder once it has used the rows."""
    path = scratch_path(spark, "batch")
    rows.write.parquet(path)
    batch = spark.read.schema(rows.schema).parquet(path)
    cols = [*table.partition_by, *range_columns]
    span = batch.agg(*_spans(batch, cols)).first()
    stored = span["n"] and table.exists()
    return int(span["n"]), insert_new_rows(batch, _existing_ids(table, cols, span) if stored else None), path


def insert_if_absent(spark: SparkSession, rows: DataFrame, table: StagingTable,
                     schema_name: str | None = None, range_columns: tuple[str, ...] = (),
                     source_id: str | None = None, day_columns: tuple[Column, ...] = ()) -> LoadReport:
    """Append the rows whose ``id`` the table does not hold yet; report the counts.

    The batch is read from its source once and kept in the shared scratch folder; its row
    count and the spans of the partition columns (and ``range_columns``, columns the id
    hashes) come from there.  ``inserted_rows`` is observed in the write's own result stage,
    whose metrics count each partition once even when tasks are retried.  An empty batch
    writes nothing (and creates no table).  ``day_columns``: expressions whose distinct days
    over the batch are reported (bounded by the calendar; None stands for rows without one).
    The kept batch is deleted once it is loaded.
    """
    schema_name = schema_name or table.namespace
    path = scratch_path(spark, "batch")
    rows.write.parquet(path)
    batch = spark.read.schema(rows.schema).parquet(path)
    cols = [*table.partition_by, *range_columns]
    span = batch.agg(*_spans(batch, cols)).first()
    if span["n"] == 0:
        remove_path(spark, path)
        return LoadReport(schema_name, table.label, 0, 0, list(rows.columns), source_id)
    if table.schema is None:
        table.schema = rows.schema
    existing = _existing_ids(table, cols, span) if table.exists() else None
    table.ensure()
    written = Observation("written")
    table.append(insert_new_rows(batch, existing), observation=written)
    days = []
    if day_columns:
        found = batch.select(F.explode(F.array(*day_columns)).alias("day")).distinct()
        days = sorted((r[0] for r in found.collect()), key=lambda d: (d is not None, d))
    remove_path(spark, path)
    return LoadReport(schema_name, table.label, int(span["n"]), int(written.get["n"]), list(rows.columns), source_id, days)


def seed_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """The target's rows, or the seed rows when the target holds none."""
    return seed if target.isEmpty() else target


def seed_table(spark: SparkSession, table: StagingTable, seed: DataFrame) -> LoadReport:
    """Insert the seed rows (with ids) into a table that holds none, creating it if absent.

    A table that holds rows is left alone: nothing is read from the seed."""
    if table.exists() and not table.read().isEmpty():
        return LoadReport(table.namespace, table.label, 0, 0, list(seed.columns))
    return insert_if_absent(spark, seed, table)


def load_frame(spark: SparkSession, raw: DataFrame, table: StagingTable,
               schema_name: str | None = None) -> LoadReport:
    """Load any source frame: clean its column names, cast to staging types, hash each
    row into ``id``, create the table from that schema if absent, insert if absent.

    Names are cleaned on every load (not only when the table is created), so a second
    load with raw names still matches the stored columns.
    """
    return insert_if_absent(spark, stage_rows(raw), table, schema_name)
