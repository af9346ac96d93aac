"""Incremental daily results: mergeable per-day states, updated from inserted rows only.

Instead of recomputing the days that a load touches, every load adds a *delta* to each state
table; a result is the sum of its deltas.  All states are Parquet folders partitioned by
``(day, batch)``:

* ``summary``: per (block date, token pair) the sums, the counts and sums behind the averages,
  and the number of transaction hashes that are new on that day and pair;
* ``hashes``: the distinct (block date, token pair, hash), so a late trade knows whether its hash
  was counted;
* ``legs`` and ``quotes``: the multisets of the price gap, distinct (slot, token, price) with the
  rows they stand for, of trade legs and of market prices;
* ``gap``: per (day, token) the weighted gap sum and the number of pairs.

With old legs L, old quotes Q and a batch's dL and dQ, the pairs that a load adds are
``dL x (Q + dQ)`` and ``L x dQ``: late trades meet the day's quotes, late prices the day's legs,
and neither reads a stored trade.  Only the touched days' folders are read.

A load first keeps its new rows under ``pending/<batch>``; once they are complete, they are
appended to the staging tables, the deltas are written, and the kept rows go.  Every one of
these steps overwrites what the batch itself wrote, so a load that died is finished (or, if its
rows were not complete, dropped) by the next one, and nothing is counted twice.  One writer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import price_gap, slot_day
from ..operators.joins import BROADCAST_MAX_ROWS
from ..operators.legs import trade_legs, weighted_prices
from ..sinks.load import LoadReport, insert_if_absent, new_rows
from ..sinks.tables import StagingTable, list_folders, path_exists, remove_path
from .price_gap import spread_join

# Columns summed per (day, pair), and those averaged.
_SUMS = {"usd_value": "total_usd_value_bought", "sell_value_usd": "total_usd_value_sold",
         "units_sold": "total_units_sold", "units_bought": "total_units_bought"}
_AVERAGES = {"buy_price": "avg_buy_price", "sell_price": "avg_sell_price"}

_STATES = {
    "summary": "day date, batch string, token_pair string, new_hashes bigint, "
               + ", ".join(f"{c} double" for c in _SUMS.values())
               + "".join(f", {c}_sum double, {c}_n bigint" for c in _AVERAGES),
    "hashes": "day date, batch string, token_pair string, tx_hash string",
    "legs": "day date, batch string, slot bigint, token string, trade_price double, m bigint",
    "quotes": "day date, batch string, slot bigint, token string, external_price double, n bigint",
    "gap": "day date, batch string, token string, gap_sum double, pairs bigint",
}


class IncrementalResults:
    """The daily summary and price gap over two staging tables, kept up to date by ``load``.

    ``root`` is a folder on shared storage.  ``mode``, ``gap``, ``mapping`` and ``on_zero`` are
    those of ``price_gap_daily`` and stay fixed for a root.
    """

    def __init__(self, spark: SparkSession, root: str, trades: StagingTable, prices: StagingTable, mode: str = "12h",
                 gap: str = "quarter", mapping=None, on_zero: str = "raise"):
        self.spark, self.root, self.trades, self.prices = spark, root.rstrip("/"), trades, prices
        self.mode, self.gap_formula, self.mapping, self.on_zero = mode, gap, mapping, on_zero

    # ----------------------------------------------------------------- states

    def state(self, name: str, days=None, without: str | None = None) -> DataFrame:
        """A state's rows, of ``days`` (None among them: the rows without a day), and without
        those of one batch."""
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _STATES[name])
        rows = self.spark.read.schema(_STATES[name]).parquet(path)
        if without is not None:
            rows = rows.where(F.col("batch") != without)
        if days is not None:
            dated = [d for d in days if d is not None]
            here = F.col("day").isin(dated) if dated else F.lit(False)
            rows = rows.where(here | F.col("day").isNull() if None in days else here)
        return rows

    def _write(self, name: str, rows: DataFrame, batch: str) -> None:
        """Replace the batch's own rows of a state, and no others."""
        columns = [c.split(" ")[0] for c in _STATES[name].split(", ")]
        out = rows.withColumn("batch", F.lit(batch)).select(*columns).hint("rebalance", "day")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(
            f"{self.root}/{name}")

    # ----------------------------------------------------------------- deltas

    def legs_of(self, trades: DataFrame) -> DataFrame:
        legs = trade_legs(trades, self.mode, fields=("token", "trade_price")).where("slot is not null")
        return legs.groupBy("slot", "token", "trade_price").agg(F.count(F.lit(1)).alias("m"))

    def quotes_of(self, prices: DataFrame) -> DataFrame:
        return weighted_prices(prices, self.mode, self.mapping).where("slot is not null")

    def with_day(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("day", F.date_from_unix_date(slot_day("slot", self.mode).cast("int")))

    def gap_delta(self, legs: DataFrame, quotes: DataFrame, old_legs: DataFrame, old_quotes: DataFrame) -> DataFrame:
        """(day, token, gap_sum, pairs) of the pairs that new legs and quotes add."""
        columns = ["slot", "token", "external_price", "n"]
        every = old_quotes.select(*columns).unionByName(quotes.select(*columns))
        parts = [spread_join(legs, every, BROADCAST_MAX_ROWS, every),
                 spread_join(old_legs.select("slot", "token", "trade_price", "m"), quotes, BROADCAST_MAX_ROWS, quotes)]
        weight = F.col("m") * F.col("n")
        diff = price_gap("trade_price", "external_price", self.gap_formula, self.on_zero)
        pairs = parts[0].select("slot", "token", "trade_price", "external_price", "m", "n").unionByName(
            parts[1].select("slot", "token", "trade_price", "external_price", "m", "n"))
        return self.with_day(pairs).groupBy("day", "token").agg(
            F.sum(diff * weight).alias("gap_sum"), F.sum(F.when(diff.isNotNull(), weight)).alias("pairs"))

    def hash_sums(self, trades: DataFrame, old_hashes: DataFrame) -> DataFrame:
        """Per (day, pair, hash) of new trades: their sums, and whether the hash is known there."""
        sums = [F.sum(c).alias(name) for c, name in _SUMS.items()]
        means = [f(c).alias(f"{c}_{end}") for c in _AVERAGES for f, end in ((F.sum, "sum"), (F.count, "n"))]
        per = trades.select(F.col("block_date").alias("day"), "token_pair", "tx_hash", *_SUMS, *_AVERAGES).groupBy(
            "day", "token_pair", "tx_hash").agg(*sums, *means).alias("p")
        old = old_hashes.select("day", "token_pair", "tx_hash").withColumn("known", F.lit(True)).alias("o")
        # A hash is counted once per day and pair, also where day or pair is missing.
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("day", "token_pair", "tx_hash")]
        is_new = F.col("known").isNull() & F.col("p.tx_hash").isNotNull()
        return per.join(old, same[0] & same[1] & same[2], "left").select("p.*", is_new.alias("is_new"))

    def apply(self, batch: str, trades: DataFrame, prices: DataFrame) -> None:
        """Add one batch's new rows to every state (again: the same states)."""
        legs, quotes = self._kept(batch, "legs", self.legs_of(trades)), self._kept(batch, "quotes", self.quotes_of(prices))
        # Days: bounded by the calendar.
        days = {k: [r[0] for r in self.with_day(df).select("day").distinct().collect()]
                for k, df in (("legs", legs), ("quotes", quotes))}
        dates = [r[0] for r in trades.select("block_date").distinct().collect()]
        sums = self._kept(batch, "hash-sums", self.hash_sums(trades, self.state("hashes", dates, batch)))
        self._write("hashes", sums.where("is_new").select("day", "token_pair", "tx_hash"), batch)
        added = [F.sum(c).alias(c) for c in sums.columns if c not in ("day", "token_pair", "tx_hash", "is_new")]
        self._write("summary", sums.groupBy("day", "token_pair").agg(
            F.count(F.when(F.col("is_new"), 1)).alias("new_hashes"), *added), batch)
        delta = self.gap_delta(legs, quotes, self.state("legs", days["quotes"], batch), self.state("quotes", days["legs"], batch))
        self._write("gap", delta, batch)
        self._write("legs", self.with_day(legs), batch)
        self._write("quotes", self.with_day(quotes), batch)

    def _kept(self, batch: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/pending/{batch}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ----------------------------------------------------------------- loads

    def load(self, trades: DataFrame | None = None, prices: DataFrame | None = None) -> list[LoadReport]:
        """Insert rows (with ids) that the staging tables do not hold yet, and update the states."""
        self.recover()
        batch = uuid.uuid4().hex[:12]
        reports = []
        for name, rows, table in (("trades", trades, self.trades), ("prices", prices, self.prices)):
            if rows is None:
                self._kept(batch, name, self.spark.createDataFrame([], table.schema))
                continue
            total, fresh, scratch = new_rows(self.spark, rows, table, ("date_time",) if name == "prices" else ())
            kept = self._kept(batch, name, fresh)
            reports.append(LoadReport(table.namespace, table.label, total, kept.count(), list(rows.columns)))
            remove_path(self.spark, scratch)
        self.spark.range(1).write.parquet(f"{self.root}/pending/{batch}/ready")
        self._finish(batch)
        return reports

    def recover(self) -> list[str]:
        """Finish the loads that died after their rows were kept, drop those that died before."""
        done = []
        for batch in list_folders(self.spark, f"{self.root}/pending"):
            if path_exists(self.spark, f"{self.root}/pending/{batch}/ready/_SUCCESS"):
                self._finish(batch)
                done.append(batch)
            else:
                remove_path(self.spark, f"{self.root}/pending/{batch}")
        return done

    def _finish(self, batch: str) -> None:
        base = f"{self.root}/pending/{batch}"
        rows = {name: self.spark.read.schema(table.schema).parquet(f"{base}/{name}")
                for name, table in (("trades", self.trades), ("prices", self.prices))}
        insert_if_absent(self.spark, rows["trades"], self.trades)
        insert_if_absent(self.spark, rows["prices"], self.prices, range_columns=("date_time",))
        self.apply(batch, rows["trades"], rows["prices"])
        remove_path(self.spark, base)

    # ----------------------------------------------------------------- results

    def summary(self) -> DataFrame:
        """As ``operators.aggregates.daily_trade_summary`` over all trades."""
        sums = [F.sum(name).alias(name) for name in _SUMS.values()]
        means = [F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(name) for c, name in _AVERAGES.items()]
        return self.state("summary").groupBy(F.col("day").alias("block_date"), "token_pair").agg(
            F.sum("new_hashes").alias("no_txn"), *sums, *means)

    def price_gap(self) -> DataFrame:
        """As ``price_gap_daily`` over all trades and prices."""
        return self.state("gap").groupBy(F.col("day").cast("string").alias("date"), "token").agg(
            F.try_divide(F.sum("gap_sum"), F.sum("pairs")).alias("avg_price_difference"))
