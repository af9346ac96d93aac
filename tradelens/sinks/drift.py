"""Staging tables whose source changes its columns.

A frame with other columns than the table is loaded if the change loses nothing, and refused
otherwise:

* an integer column that now holds reals, or the other way round, becomes ``DOUBLE``;
* a new column joins, NULL in the rows loaded before; a column that is gone is NULL from now on;
* any other change of type, two columns of one cleaned name, and integers beyond 2^53 in a column
  that would become ``DOUBLE`` raise ``SchemaDrift`` before anything is written.

Stored rows are never rewritten.  Every change opens a folder of its own, ``v=0``, ``v=1``, ...,
with its own schema, and a read unites them under the newest one, so filters and column selection
still reach each folder's scan.  A row's id does not depend on when it was loaded (see
``functions.identity.content_id``), so a replay of old rows in the new layout adds nothing.
"""

from __future__ import annotations

import functools
from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import EXACT_WHOLE, content_id
from ..functions.naming import clean_columns, staging_types
from .load import LoadReport, insert_if_absent
from .tables import StagingTable, list_folders

_NUMBERS = (T.LongType(), T.DoubleType())


class SchemaDrift(ValueError):
    """A frame does not fit the table; ``reasons`` names every column and why."""

    def __init__(self, reasons: list[str]):
        super().__init__("; ".join(reasons))
        self.reasons = reasons


def merged_schema(stored: T.StructType, frame: T.StructType) -> T.StructType:
    """The table's columns after the frame: stored ones in their order, then the new ones."""
    counts = Counter(f.name for f in frame.fields)
    reasons = [f"{n}: {c} columns of this name" for n, c in counts.items() if c > 1]
    types = {f.name: f.dataType for f in stored.fields}
    for f in frame.fields:
        old = types.get(f.name)
        if old is None or old == f.dataType:
            types[f.name] = f.dataType
        elif old in _NUMBERS and f.dataType in _NUMBERS:
            types[f.name] = T.DoubleType()
        else:
            reasons.append(f"{f.name}: {old.simpleString()} cannot become {f.dataType.simpleString()}")
    if reasons:
        raise SchemaDrift(reasons)
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


class DriftingTable(StagingTable):
    """A staging table in a folder, one subfolder per schema it has had (single writer)."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path=path)

    def versions(self) -> list[T.StructType]:
        """The schemas so far, oldest first, read from the folders' own files."""
        numbers = sorted(int(n[2:]) for n in list_folders(self.spark, self.path) if n.startswith("v="))
        return [self.spark.read.parquet(f"{self.path}/v={n}").schema for n in numbers]

    def _version(self, number: int, schema: T.StructType) -> StagingTable:
        return StagingTable(self.spark, path=f"{self.path}/v={number}", schema=schema)

    def exists(self) -> bool:
        return bool(list_folders(self.spark, self.path))

    def ensure(self, schema: T.StructType | None = None) -> bool:
        """Open a new version if ``schema`` (the table's own by default) is not the newest one."""
        schema, known = schema or self.schema, self.versions()
        if known and known[-1] == schema:
            return False
        return self._version(len(known), schema).ensure()

    def read(self) -> DataFrame:
        known = self.versions()
        newest = known[-1]

        def united(number: int, schema: T.StructType) -> DataFrame:
            rows, names = self._version(number, schema).read(), set(schema.names)
            return rows.select(*[(F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                                 for f in newest.fields])

        return functools.reduce(DataFrame.unionByName, [united(n, s) for n, s in enumerate(known)])

    def append(self, df: DataFrame, observation: Observation | None = None) -> None:
        known = self.versions()
        self._version(len(known) - 1, known[-1]).append(df, observation)


def load_drifting(spark: SparkSession, raw: DataFrame, table: DriftingTable) -> LoadReport:
    """Load a source frame: clean its names, cast to staging types, fit it to the table's columns
    or the table's columns to it, hash, insert if absent.  Raises ``SchemaDrift``."""
    # Cleaning may make two names equal, which must be known before a column is addressed by name.
    cleaned = clean_columns(raw)
    merged_schema(T.StructType([]), cleaned.schema)
    rows = staging_types(cleaned.drop("id"))
    known = table.versions()
    stored = T.StructType([f for f in known[-1].fields if f.name != "id"]) if known else T.StructType([])
    merged = merged_schema(stored, rows.schema)
    _check_whole(rows, merged, "the frame")
    if known:
        _check_whole(table.read(), merged, "the table", stored)
    first: dict[str, T.DataType] = {}
    for schema in [*known, merged]:
        for f in schema.fields:
            first.setdefault(f.name, f.dataType)
    base = set((known[0] if known else merged).names)
    here = set(rows.columns)
    rows = rows.select(*[(F.col(f"`{f.name}`") if f.name in here else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in merged.fields])
    added = tuple(n for n in merged.names if n not in base)
    whole = tuple(f.name for f in merged.fields if f.dataType == T.DoubleType() and first[f.name] == T.LongType())
    rows = rows.select(content_id(rows, added=added, whole=whole).alias("id"), *[F.col(f"`{c}`") for c in merged.names])
    # Files do not tell a column without nulls from one that may hold them.
    table.schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return insert_if_absent(spark, rows, table)


def _check_whole(rows: DataFrame, merged: T.StructType, where: str, schema: T.StructType | None = None) -> None:
    """Refuse to turn integers into doubles where that would merge different ones.  The filter is
    on bare columns, so the statistics of stored files answer it."""
    now = {f.name: f.dataType for f in merged.fields}
    turned = [f.name for f in (schema or rows.schema).fields if f.dataType == T.LongType() and now[f.name] == T.DoubleType()]
    reasons = [f"{n}: integers beyond 2^53 in {where}" for n in turned
               if not rows.where((F.col(f"`{n}`") > int(EXACT_WHOLE)) | (F.col(f"`{n}`") < -int(EXACT_WHOLE))).isEmpty()]
    if reasons:
        raise SchemaDrift(reasons)
