"""Batch jobs: initial backfill and the daily incremental load.

Every job takes an explicit ``as_of`` date (never the current date), so reruns are
reproducible; loads are idempotent, so a rerun of the same day adds nothing.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.identity import with_row_id
from .functions.scalars import days_before, month_start
from .operators.aggregates import daily_trade_summary
from .plans.price_gap import price_gap_daily
from .schemas import COIN_PRICES, REJECTED_DOCS, TRADES
from .sinks.ledger import DONE, STARTED, loaded_days, next_attempt, open_windows, write_entry
from .sinks.load import LoadReport, insert_if_absent
from .session import scratch_path
from .sinks.tables import StagingTable, remove_path
from .sinks.views import publish_views
from .sources.prices import checked_price_docs, loadable_prices, price_window, rejected_docs

# The coins and the trade direction loaded by default.
DEFAULT_COINS = ("ethereum", "usd-coin")
DEFAULT_BUY_TOKEN, DEFAULT_SELL_TOKEN = "WETH", "USDC"

TRADE_COLUMNS = [f.name for f in TRADES.fields if f.name != "id"]
PRICE_COLUMNS = [f.name for f in COIN_PRICES.fields if f.name != "id"]


def _day(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def trades_table(spark: SparkSession, name: str | None = None, path: str | None = None,
                 buckets: int | None = None) -> StagingTable:
    """Partitioned by ``block_date``; a catalog table may be bucketed by ``tx_hash`` so the
    daily summary's distinct count runs without shuffling the stored trades."""
    return StagingTable(spark, name=name, path=path, schema=TRADES, partition_by=["block_date"],
                        bucket_by=("tx_hash", buckets) if buckets else None)


def prices_table(spark: SparkSession, name: str | None = None, path: str | None = None) -> StagingTable:
    """Partitioned by coin: the id hashes the coin, so a load reads only its coins' ids."""
    return StagingTable(spark, name=name, path=path, schema=COIN_PRICES, partition_by=["coin"])


def rejected_table(spark: SparkSession, name: str | None = None, path: str | None = None) -> StagingTable:
    """The quarantine of price documents that do not load, partitioned by coin."""
    return StagingTable(spark, name=name, path=path, schema=REJECTED_DOCS, partition_by=["coin"])


def load_price_docs(spark: SparkSession, docs: DataFrame, prices: StagingTable, rejected: StagingTable) -> DocLoad:
    """Load landed documents (``sources.prices.landed_docs``): their points into ``prices``, the
    documents that do not load into ``rejected``, each once however often they are read.

    The documents are parsed once, into the shared scratch folder."""
    path = scratch_path(spark, "docs")
    checked = checked_price_docs(docs)
    checked.write.parquet(path)
    checked = spark.read.schema(checked.schema).parquet(path)
    counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")).first()
    points = insert_if_absent(spark, with_row_id(loadable_prices(checked).select(*PRICE_COLUMNS)), prices, range_columns=("date_time",))
    rejected.ensure()
    bad = insert_if_absent(spark, with_row_id(rejected_docs(checked)), rejected)
    remove_path(spark, path)
    return DocLoad(counts["n"], counts["n"] - counts["bad"], counts["bad"], points, bad)


@dataclass
class DocLoad:
    """Documents read, loaded and rejected (they add up), and the reports of the two tables."""

    documents: int
    loaded: int
    rejected: int
    points: LoadReport
    quarantine: LoadReport


def load_trades(spark: SparkSession, source: DataFrame, table: StagingTable, as_of, initial: bool = False,
                buy_token: str = DEFAULT_BUY_TOKEN, sell_token: str = DEFAULT_SELL_TOKEN,
                directions: list[tuple[str, str]] | None = None, source_id: str | None = None,
                start=None) -> LoadReport:
    """Month-to-date (initial; from ``start`` if given) or previous-day (daily) trades of one
    direction, or of several ``directions`` ``[(buy_token, sell_token), ...]`` loaded as one
    batch: one scan with the OR of the token filters, one anti-join, one append."""
    d = _day(as_of)
    pairs = directions or [(buy_token, sell_token)]
    tokens = F.lit(False)
    for buy, sell in pairs:
        tokens = tokens | ((F.col("buy_token") == buy) & (F.col("sell_token") == sell))
    day = F.col("block_date")
    since = month_start(F.lit(d)) if start is None else F.lit(_day(start))
    window = ((day >= since) & (day < F.lit(d))) if initial else (day == days_before(F.lit(d), 1))
    return insert_if_absent(spark, with_row_id(source.where(tokens & window).select(*TRADE_COLUMNS)), table,
                            source_id=source_id, day_columns=(F.to_date("block_time"), F.col("block_date")))


def load_prices(spark: SparkSession, source: DataFrame, table: StagingTable, coin, as_of,
                initial: bool = False, start=None, source_id: str | None = None) -> LoadReport:
    """Prices of one coin (or a list of coins, loaded as one batch from one scan):
    ``[start, as_of - 1]`` (initial) or the day before ``as_of``."""
    d = _day(as_of)
    coins = [coin] if isinstance(coin, str) else list(coin)
    last = d - dt.timedelta(days=1)
    first = (_day(start) if start is not None else d.replace(day=1)) if initial else last
    rows = price_window(source, coins, f"{first.isoformat()} 00:00:00", f"{last.isoformat()} 23:59:59")
    return insert_if_absent(spark, with_row_id(rows.select(*PRICE_COLUMNS)), table, range_columns=("date_time",),
                            source_id=source_id, day_columns=(F.to_date(F.col("date_time").cast("timestamp_ntz")),))


def daily_load(spark: SparkSession, trade_source: DataFrame, price_source: DataFrame,
               trades: StagingTable, prices: StagingTable, as_of,
               coins=DEFAULT_COINS, views_db: str | None = None,
               directions: list[tuple[str, str]] | None = None,
               results: tuple[str, str] | None = None, on_zero: str = "raise") -> list[LoadReport]:
    """The scheduled daily task: previous-day trades, then the coins' previous-day prices
    (all coins in one batch: one scan, one anti-join, one append).  With ``views_db``
    the views are published (catalog tables only); with ``results=(summary_path, gap_path)``
    the results of every day the batches touch are materialized.  ``on_zero`` is what both do
    where prices sum to zero, as in ``price_gap_daily``."""
    _check_views(trades, prices, views_db)

    def load():
        return [load_trades(spark, trade_source, trades, as_of, directions=directions),
                load_prices(spark, price_source, prices, list(coins), as_of)]

    reports = load_and_refresh(spark, trades, prices, results, load, on_zero) if results is not None else load()
    if views_db is not None:
        publish_views(spark, trades.name, prices.name, target=views_db, on_zero=on_zero)
    return reports


def load_and_refresh(spark: SparkSession, trades: StagingTable, prices: StagingTable, results: tuple[str, str],
                     load, on_zero: str = "raise") -> list[LoadReport]:
    """Run ``load()`` and refresh the materialized results of every day its batches touch,
    whichever days those are (late prices, trades whose time lies off their date).

    The days come from the batches, not from the rows that were new: a rerun after a crash
    between load and refresh finds nothing new, but refreshes the same days.
    """
    reports = load()
    days = {d for r in reports for d in r.days}
    if days and trades.exists() and prices.exists():
        refresh_daily_results(spark, trades.read(), prices.read(), days, *results, on_zero=on_zero)
    return reports


def _check_views(trades: StagingTable, prices: StagingTable, views_db: str | None) -> None:
    if views_db is not None and not (trades.name and prices.name):
        raise ValueError("views need catalog tables: a path table has no name a view could read")


def backfill(spark: SparkSession, trade_source: DataFrame, price_source: DataFrame,
             trades: StagingTable, prices: StagingTable, as_of, start=None,
             coins=DEFAULT_COINS, views_db: str | None = None,
             directions: list[tuple[str, str]] | None = None,
             results: tuple[str, str] | None = None, on_zero: str = "raise") -> list[LoadReport]:
    """Initial load: both coins' prices from ``start``, month-to-date trades, then the views.

    Both tables are created with their declared schema first, so the views can be
    published even when a window is empty (the 1st of a month).
    """
    _check_views(trades, prices, views_db)
    trades.ensure()
    prices.ensure()

    def load():
        return [load_prices(spark, price_source, prices, list(coins), as_of, initial=True, start=start),
                load_trades(spark, trade_source, trades, as_of, initial=True, directions=directions)]

    reports = load_and_refresh(spark, trades, prices, results, load, on_zero) if results is not None else load()
    if views_db is not None:
        publish_views(spark, trades.name, prices.name, target=views_db, on_zero=on_zero)
    return reports


def job_name(coins=DEFAULT_COINS, directions: list[tuple[str, str]] | None = None) -> str:
    """What a backfill loads, as the ledger names it: other coins or directions are another job."""
    pairs = directions or [(DEFAULT_BUY_TOKEN, DEFAULT_SELL_TOKEN)]
    return "; ".join([", ".join(sorted(f"{sell}->{buy}" for buy, sell in pairs)), ", ".join(sorted(coins))])


def resumable_backfill(spark: SparkSession, trade_source: DataFrame, price_source: DataFrame,
                       trades: StagingTable, prices: StagingTable, ledger: StagingTable, as_of, start=None,
                       window_days: int = 1, coins=DEFAULT_COINS, views_db: str | None = None,
                       directions: list[tuple[str, str]] | None = None,
                       results: tuple[str, str] | None = None, on_zero: str = "raise") -> list[LoadReport]:
    """``backfill`` in windows of ``window_days`` days from ``start`` (the month's first day) to the
    day before ``as_of``, each written to the ledger (``sinks.ledger``) when it is done.

    Days that the ledger holds as done are not read again, so a run that died goes on where it
    stopped, and a later ``as_of`` loads the days that are new.  A window that died half-way is
    loaded again and adds only what is missing; with ``results`` its days are refreshed before
    it counts as done.  The views are published once every window is done.  Sources must be
    settled for the days they are asked for: rows that come late to a finished day are the
    daily load's, not this job's."""
    _check_views(trades, prices, views_db)
    for table in (trades, prices, ledger):
        table.ensure()
    d, job = _day(as_of), job_name(coins, directions)
    first = d.replace(day=1) if start is None else _day(start)
    out = []
    for window in open_windows(first, d - dt.timedelta(days=1), loaded_days(ledger, job), window_days):
        attempt = next_attempt(ledger, job, window)
        write_entry(ledger, job, window, attempt, STARTED)
        end = window[1] + dt.timedelta(days=1)

        def load(begin=window[0], end=end):
            return [load_prices(spark, price_source, prices, list(coins), end, initial=True, start=begin),
                    load_trades(spark, trade_source, trades, end, initial=True, directions=directions, start=begin)]

        loaded = load_and_refresh(spark, trades, prices, results, load, on_zero) if results is not None else load()
        of_prices, of_trades = loaded
        write_entry(ledger, job, window, attempt, DONE, (of_trades.total_rows, of_trades.inserted_rows,
                                                         of_prices.total_rows, of_prices.inserted_rows))
        out += loaded
    if views_db is not None:
        publish_views(spark, trades.name, prices.name, target=views_db, on_zero=on_zero)
    return out


def refresh_daily_results(spark: SparkSession, trades: DataFrame, prices: DataFrame, days,
                          summary_path: str, gap_path: str, mode: str = "12h",
                          gap: str = "quarter", on_zero: str = "raise") -> None:
    """Materialize the two daily results for ``days`` only, replacing those days.

    Both results are per day: a day's summary reads the trades of that ``block_date`` (None:
    those without one), its price gap the trades and prices whose hour slot lies on it, whatever
    their ``block_date``.  Every day of ``days`` is replaced (see ``replace_days``).
    """
    days = {d if d is None else _day(d) for d in days}
    if not days:
        return
    dated = sorted(days - {None})
    of_days = F.col("block_date").isin(dated) if dated else F.lit(False)
    if None in days:
        of_days = of_days | F.col("block_date").isNull()
    replace_days(spark, daily_trade_summary(trades.where(of_days)), summary_path, "block_date", days)
    slots = price_gap_daily(trades.where(in_days("block_time", dated)), prices.where(in_days("date_time", dated, text=True)),
                            mode=mode, gap=gap, on_zero=on_zero)
    replace_days(spark, slots, gap_path, "date", dated)


#: Stretches of days that become ranges of their own in a filter; beyond it, one range from the
#: first to the last day and the list of days.
MAX_RANGES = 64


def in_days(column: str, days, text: bool = False) -> Column:
    """Whether a timestamp (or ``yyyy-MM-dd HH:mm:ss`` text) lies on one of ``days``.

    Days in a row are one range of the bare column, so the filter reaches the scan's
    statistics; it never casts the column."""
    days = sorted({_day(d) for d in days})
    if not days:
        return F.lit(False)
    starts = [d for i, d in enumerate(days) if not i or days[i - 1] != d - dt.timedelta(days=1)]
    ends = [d + dt.timedelta(days=1) for i, d in enumerate(days) if i + 1 == len(days) or days[i + 1] != d + dt.timedelta(days=1)]

    def bound(d: dt.date) -> Column:
        return F.lit(d.isoformat()) if text else F.lit(d.isoformat()).cast("timestamp_ntz")

    def within(start: dt.date, end: dt.date) -> Column:
        return (F.col(column) >= bound(start)) & (F.col(column) < bound(end))

    if len(starts) > MAX_RANGES:
        day = F.substring(column, 1, 10) if text else F.to_date(column).cast("string")
        return within(starts[0], ends[-1]) & day.isin([d.isoformat() for d in days])
    return functools.reduce(operator.or_, [within(a, b) for a, b in zip(starts, ends, strict=True)])


def replace_days(spark: SparkSession, df: DataFrame, path: str, column: str, days) -> None:
    """Replace exactly the folders of ``days`` (None: the one of missing values) of a result
    partitioned by ``column`` with the rows of ``df``, which lie on those days.

    The new rows are written by a dynamic partition overwrite: Spark computes them into a staging
    folder and swaps each day's folder when the job commits, so readers see a day's old or new
    rows while it is computed, and a run that dies before leaves the old ones.  Days that have no
    rows any more are removed afterwards.  A rerun gives the same result.
    """
    kept = scratch_path(spark, "results")
    df.write.parquet(kept)
    fresh = spark.read.schema(df.schema).parquet(kept)
    fresh.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    # A row per day at most, of a result that holds a few rows a day.
    there = {None if r[0] is None else str(r[0]) for r in fresh.select(column).distinct().collect()}
    for d in days:
        name = None if d is None else _day(d).isoformat()
        if name not in there:
            remove_path(spark, f"{path}/{column}={NULL_FOLDER if name is None else name}")
    remove_path(spark, kept)


# Fixed value: the folder of rows without a partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


# Declared schemas of the materialized results (partition discovery would read the
# gap's ``date`` text back as a DATE).
SUMMARY_RESULT_DDL = ("block_date date, token_pair string, no_txn bigint, total_usd_value_bought double, "
                      "total_usd_value_sold double, total_units_sold double, total_units_bought double, "
                      "avg_buy_price double, avg_sell_price double")
GAP_RESULT_DDL = "date string, token string, avg_price_difference double"


def read_daily_results(spark: SparkSession, summary_path: str, gap_path: str) -> tuple[DataFrame, DataFrame]:
    """The materialized (summary, price gap) written by ``refresh_daily_results``."""
    return (spark.read.schema(SUMMARY_RESULT_DDL).parquet(summary_path),
            spark.read.schema(GAP_RESULT_DDL).parquet(gap_path))
