"""Landed price documents -> idempotent staging appends, as a Structured Stream.

``readStream.json`` picks up new document files under ``<root>/coin=<id>/``; each
micro-batch is exploded to price rows, given content-hash ids and inserted if
absent.  ``foreachBatch`` is at-least-once; the id makes a replayed batch (or a
whole replay with a new checkpoint) add nothing.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.identity import with_row_id
from ..schemas import COIN_PRICES, PRICE_DOC_DDL
from ..sinks.load import insert_if_absent
from ..sinks.tables import StagingTable
from ..jobs import load_price_docs
from ..sources.prices import PRICE_ROW_COLUMNS, explode_price_docs, landed_docs

# Files of one micro-batch: a replayed backlog is loaded in bounded steps.
MAX_FILES_PER_TRIGGER = 1_000

PRICE_COLUMNS = [f.name for f in COIN_PRICES.fields if f.name != "id"]


def land_price_docs(docs: DataFrame, path: str) -> None:
    """Write (coin, doc) rows as JSON-lines files under ``path/coin=<id>/``."""
    docs.select("coin", "doc").write.mode("append").partitionBy("coin").text(path)


def stream_price_docs(spark: SparkSession, landing: str, table: StagingTable, checkpoint: str,
                      available_now: bool = True, multi_line: bool = False,
                      max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                      archive_dir: str | None = None, rejected: StagingTable | None = None,
                      on_batch=None) -> StreamingQuery:
    """Start the load; ``checkpoint`` must be in shared storage.

    With ``rejected`` (``jobs.rejected_table``) documents that do not load go there with file and
    reason, and the rest of their batch loads; without it, documents without prices are
    skipped and arrays of unequal length stop the stream.  ``on_batch(epoch, report)`` gets each
    micro-batch's report: a ``jobs.DocLoad`` with ``rejected``, else a ``LoadReport``.

    ``archive_dir`` moves each landed file there once its batch is committed
    (``cleanSource=archive``), so the landing folder, which is listed on every
    trigger, holds only files not yet loaded rather than the whole history.
    """
    options = {}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = max_files_per_trigger
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    if rejected is not None:
        staged = landed_docs(spark, landing, multi_line, stream_options=options)
    else:
        src = spark.readStream.schema(PRICE_DOC_DDL + ", coin string").option("multiLine", str(multi_line).lower())
        rows = explode_price_docs(src.options(**options).json(landing)).select(*PRICE_ROW_COLUMNS, "coin")
        staged = with_row_id(rows.select(*PRICE_COLUMNS))
    return _started(staged, table, checkpoint, available_now, rejected, on_batch)


def stream_day_documents(spark: SparkSession, source: str, options: dict, table: StagingTable, rejected: StagingTable,
                         checkpoint: str, available_now: bool = True, on_batch=None) -> StreamingQuery:
    """Start the load of a ``sources.day_documents`` format, by the rules of ``stream_price_docs``
    with ``rejected``: the days complete now, or each day as it becomes complete."""
    docs = spark.readStream.format(source).options(**options).load()
    staged = docs.select(F.col("key").alias("coin"), "file", "doc")
    return _started(staged, table, checkpoint, available_now, rejected, on_batch)


def _started(staged: DataFrame, table: StagingTable, checkpoint: str, available_now: bool, rejected: StagingTable | None,
             on_batch) -> StreamingQuery:
    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # The batch runs in a cloned session: read the target through it, so the anti-join
        # sees the files appended by earlier batches.  The load keeps the parsed batch in the
        # shared scratch folder, so the documents are parsed once.
        target = dataclasses.replace(table, spark=batch.sparkSession)
        if rejected is not None:
            report = load_price_docs(batch.sparkSession, batch, target, dataclasses.replace(rejected, spark=batch.sparkSession))
        else:
            report = insert_if_absent(batch.sparkSession, batch, target, range_columns=("date_time",))
        if on_batch is not None:
            on_batch(epoch_id, report)

    writer = staged.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
