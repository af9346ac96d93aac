"""The load ledger: which windows of a job are loaded, so that a failed backfill goes on there.

A window is written down as ``started`` before its loads and as ``done``, with its counts, after
them.  A run that dies leaves a ``started`` row without a ``done`` one; the next run loads that
window again, which adds only the rows that are missing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER
from .tables import StagingTable

STARTED, DONE = "started", "done"


def ledger_table(spark: SparkSession, name: str | None = None, path: str | None = None) -> StagingTable:
    return StagingTable(spark, name=name, path=path, schema=LEDGER)


def write_entry(ledger: StagingTable, job: str, window: tuple[dt.date, dt.date], attempt: int, state: str,
                counts: tuple[int | None, ...] = (None, None, None, None)) -> None:
    """Append one row; ``counts`` are those of the columns after ``state``."""
    ledger.append(ledger.spark.createDataFrame([(job, *window, attempt, state, *counts)], LEDGER))


def _entries(ledger: StagingTable, job: str) -> DataFrame:
    return ledger.read().where(F.col("job") == job)


def loaded_days(ledger: StagingTable, job: str) -> set[dt.date]:
    """The days of the job's finished windows (bounded by the calendar)."""
    rows = _entries(ledger, job).where(F.col("state") == DONE).select(
        F.explode(F.sequence("first_day", "last_day")).alias("day")).distinct()
    return {r.day for r in rows.collect()}


def next_attempt(ledger: StagingTable, job: str, window: tuple[dt.date, dt.date]) -> int:
    first, last = window
    tried = _entries(ledger, job).where((F.col("state") == STARTED) & (F.col("first_day") == first) & (F.col("last_day") == last))
    return (tried.agg(F.max("attempt")).first()[0] or 0) + 1


def open_windows(first: dt.date, last: dt.date, loaded: set[dt.date], window_days: int) -> list[tuple[dt.date, dt.date]]:
    """The days of ``[first, last]`` that are not ``loaded``, in windows of consecutive days, each
    at most ``window_days`` long."""
    if window_days < 1:
        raise ValueError("a window has at least one day")
    one, windows = dt.timedelta(days=1), []
    for day in (first + one * i for i in range((last - first).days + 1)):
        if day in loaded:
            continue
        if windows and windows[-1][1] + one == day and (day - windows[-1][0]).days < window_days:
            windows[-1] = (windows[-1][0], day)
        else:
            windows.append((day, day))
    return windows


def progress(ledger: StagingTable, job: str) -> DataFrame:
    """One row per window: ``first_day, last_day, attempts, state`` and the counts of its last
    finished attempt (null until then).

    ``new_trades`` and ``new_prices`` are what that attempt added: rows that an earlier, dead
    attempt had stored are not among them."""
    done = F.max_by(F.struct(*LEDGER.fieldNames()[5:]), F.when(F.col("state") == DONE, F.col("attempt")))
    per = _entries(ledger, job).groupBy("first_day", "last_day").agg(
        F.max("attempt").alias("attempts"), F.max(F.col("state") == DONE).alias("finished"), done.alias("counts"))
    return per.select("first_day", "last_day", "attempts", F.when(F.col("finished"), DONE).otherwise(STARTED).alias("state"),
                      "counts.*")
