"""Aggregations: daily trade summary, headline totals, token list and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even, text_to_date
from .joins import BROADCAST_MAX_ROWS, checked_broadcast
from .legs import mapped_prices, trade_legs


def daily_trade_summary(trades: DataFrame) -> DataFrame:
    """Per (block_date, token_pair): distinct transactions, four sums, two plain averages.

    The distinct count is planned as a partial aggregate on (keys, tx_hash) shuffled
    by all three columns, so a hot (day, pair) group is spread by its hashes.
    """
    return trades.groupBy("block_date", "token_pair").agg(
        F.count_distinct("tx_hash").alias("no_txn"),
        F.sum("usd_value").alias("total_usd_value_bought"),
        F.sum("sell_value_usd").alias("total_usd_value_sold"),
        F.sum("units_sold").alias("total_units_sold"),
        F.sum("units_bought").alias("total_units_bought"),
        F.avg("buy_price").alias("avg_buy_price"),
        F.avg("sell_price").alias("avg_sell_price"),
    )


def headline_totals(summary: DataFrame) -> DataFrame:
    """The five dashboard totals over the daily summary (one row).

    ``no_trades`` sums the per-(day, pair) distinct counts, so a hash seen on two days
    counts twice.  The other four are sums rounded half-even to integers.
    """
    return summary.agg(
        F.sum("no_txn").cast("long").alias("no_trades"),
        *[round_half_even(F.sum(c)).alias(name) for name, c in _TOTALS.items()])


# The summary column behind each total.
_TOTALS = {"units_bought": "total_units_bought", "units_sold": "total_units_sold",
           "value_sold": "total_usd_value_sold", "value_bought": "total_usd_value_bought"}


def headline_totals_of_trades(trades: DataFrame) -> DataFrame:
    """``headline_totals`` and ``no_trades_distinct`` (hashes over all days) from one scan.

    The trades are aggregated once per (day, pair, hash): a group with a hash is one distinct
    transaction of its day and pair, and the hashes of the groups give the global count.
    """
    per_hash = trades.groupBy("block_date", "token_pair", "tx_hash").agg(
        F.sum("units_bought").alias("total_units_bought"), F.sum("units_sold").alias("total_units_sold"),
        F.sum("sell_value_usd").alias("total_usd_value_sold"), F.sum("usd_value").alias("total_usd_value_bought"))
    return per_hash.agg(
        F.count("tx_hash").alias("no_trades"),
        *[round_half_even(F.sum(c)).alias(name) for name, c in _TOTALS.items()],
        F.count_distinct("tx_hash").alias("no_trades_distinct"))


def token_list(gap: DataFrame) -> DataFrame:
    return gap.select("token").distinct()


def tokens_with_prices(trades: DataFrame, prices: DataFrame, mode: str = "12h", mapping=None,
                       broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``token_list`` of the daily price gap, from its inputs: the tokens with a leg and a price in
    one hour slot.  Distinct (slot, token) of the legs meet those of the prices, so no pair of a
    leg and a price is formed and no gap computed."""
    side = mapped_prices(prices, mode, mapping)
    keys = side.select("slot", "token").distinct()
    legs = trade_legs(trades, mode, fields=("token",)).select("slot", "token").distinct()
    return legs.join(checked_broadcast(keys, broadcast_max_rows, side), ["slot", "token"], "left_semi").select(
        "token").distinct()


def token_series(gap: DataFrame) -> DataFrame:
    """One ordered series per token in long form: (token, seq, date, avg_price_difference).

    ``gap`` is already aggregated to one row per (day, token), so a window partition
    holds one token's days.
    """
    w = Window.partitionBy("token").orderBy("date")
    return (gap.select("token", text_to_date("date").alias("date"), "avg_price_difference")
            .withColumn("seq", F.row_number().over(w).cast("long"))
            .select("token", "seq", "date", "avg_price_difference"))


def series_for_token(gap: DataFrame, token: str) -> DataFrame:
    """The dashboard trace of one token: its rows, date parsed, sorted by date."""
    return (gap.where(F.col("token") == token)
            .select(text_to_date("date").alias("date"), "avg_price_difference")
            .orderBy("date"))
