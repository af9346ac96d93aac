"""Helpers shared by the training-data operators: scratch tables, document keys, file access."""

from __future__ import annotations

import os
import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.session import scratch_path


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back; ``options`` of the writer.

    This cuts the lineage in a place every executor can read, so lost executors cost no
    recomputation, and it makes the planner see the table's real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs ``(k1, k2)`` that identify a document by its id and its whole text.

    Both are defined for nulls.  Rows that agree in id and text get the same key: they are
    one document, repeated, and operators give them the same result.
    """
    return [F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.lit(1), F.col(text_col)).alias("k2")]


def with_doc_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(*doc_key(id_col, text_col), F.col(id_col), F.col(text_col))


def keyed_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(k1, k2, row)``: the document key beside the whole row as a struct, so that no column of
    the input can clash with a working column; ``row.*`` gives the input's columns back."""
    return df.select(*doc_key(id_col, text_col), F.struct("*").alias("row"))


def crc32_mod(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``: the fold of a labelled row."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(n)


# --------------------------------------------------------------------------- files

def _filesystem(path: str):
    """The Arrow filesystem of a path or URI, and the path within it."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_file(folder: str, name: str, parts) -> int:
    """Write byte parts to ``folder/name`` on the shared store; returns the size.

    The bytes go to a temporary name first and are moved into place whole, so a retried or
    speculative task replaces the same file with the same bytes and no reader sees a part.
    """
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    tmp = f"{base}/_tmp-{uuid.uuid4().hex}"
    size = 0
    with store.open_output_stream(tmp) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    store.move(tmp, f"{base}/{name}")
    return size


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, existing folder on the shared store, for files that tasks write."""
    folder = scratch_path(spark, name)
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    return folder


def read_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``(path, content)`` of the files in ``folder``, one row per file, by Spark's reader."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
            .select("path", "content"))


def per_process(key, make):
    """``make()`` once per worker process and ``key``; reused workers share it over tasks."""
    state = sys.modules.setdefault("_tradelens_llm_state", types.ModuleType("_tradelens_llm_state")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def ship_package() -> None:
    """Send this package's functions to the workers by value.

    Python tasks then need nothing installed beyond the public libraries, whatever the
    executors' working folder is.
    """
    top = __name__.split(".")[0]
    for name, module in list(sys.modules.items()):
        if name.startswith(f"{top}.llm") and os.path.isfile(getattr(module, "__file__", None) or ""):
            cloudpickle.register_pickle_by_value(module)
