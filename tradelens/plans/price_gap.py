"""Daily average gap between trade price and market price, per token.

The average runs over every (trade leg, price row) pair of an hour slot and token.  Two plans
give the same rows:

* ``single_join`` (default): both sides are first reduced to distinct (slot, token, price)
  with a multiplicity, ``m`` legs and ``n`` prices; a joined row stands for ``m * n`` pairs.
  So the work follows the distinct prices, not the rows, and one hot hour shrinks before it is
  shuffled.  The price side is broadcast only under its measured bound; beyond it, legs are
  spread over ``SALTS`` salts by their price and the price side is sent to each, so a hot slot
  is joined by many tasks whatever its bytes.
* ``union``: sell legs UNION ALL buy legs, then the pairs row by row: equal legs and prices are
  not counted together.  Kept as the reference form and cross-check.

In both the joined rows are blocks of legs by blocks of prices (``operators.blocks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import COIN_TOKENS, hour_slot, hour_text_from_slot, slot_day
from ..operators.blocks import SALTS, gap_sum, in_blocks, pair_count
from ..operators.joins import BROADCAST_MAX_ROWS, trade_price_left_join, within_bound
from ..operators.legs import (keyed_prices, leg_price_pairs, legs_union_all, mapped_prices, trade_legs,
                              weighted_prices)


def price_gap_daily(trades: DataFrame, prices: DataFrame, mode: str = "12h", gap: str = "quarter",
                    plan: str = "single_join", mapping=None,
                    broadcast_max_rows: int = BROADCAST_MAX_ROWS, on_zero: str = "raise",
                    dedupe_prices: str = "none") -> DataFrame:
    """Columns: date (``yyyy-MM-dd`` text), token, avg_price_difference.

    ``on_zero='null'`` skips pairs whose prices sum to zero instead of failing; ``'ieee'`` keeps
    them as ``price_gap`` says, so the average of their day and token is no number.
    ``dedupe_prices='avg'`` first averages the prices of each (hour key, token), so a
    trade meets one price per key instead of every price row (a different result).
    """
    if dedupe_prices not in ("none", "avg"):
        raise ValueError("dedupe_prices must be 'none' or 'avg'")
    if plan == "union":
        if dedupe_prices != "none":
            raise ValueError("the union plan has no dedupe_prices option")
        pairs = leg_price_pairs(legs_union_all(trades, mode), prices, mode, gap, mapping, broadcast_max_rows, on_zero,
                                packed=True)
        return _daily_average(pairs, mode, gap, on_zero)
    if plan != "single_join":
        raise ValueError("plan must be 'single_join' or 'union'")
    legs = trade_legs(trades, mode, fields=("token", "trade_price")).groupBy("slot", "token", "trade_price").agg(
        F.count(F.lit(1)).alias("m"))
    if dedupe_prices == "avg":
        side = mapped_prices(prices, mode, mapping).groupBy("slot", "token").agg(
            F.avg("external_price").alias("external_price"), F.lit(1).cast("long").alias("n"))
    else:
        side = weighted_prices(prices, mode, mapping)
    pairs = _spread_blocks(legs, side, broadcast_max_rows, mapped_prices(prices, mode, mapping))
    return _daily_average(pairs, mode, gap, on_zero)


def _daily_average(pairs: DataFrame, mode: str, gap: str, on_zero: str) -> DataFrame:
    """The gaps of joined blocks, averaged per day and token.  Groups on the integer day (cheap per joined
    row) and formats the date text only on the aggregated rows.  Like AVG, pairs whose gap is NULL
    (a NULL price) count in neither sum."""
    daily = pairs.groupBy(slot_day("slot", mode).alias("day"), "token").agg(
        F.sum(gap_sum(gap, on_zero)).alias("gap_sum"), F.sum(pair_count(on_zero)).alias("pairs"))
    return daily.select(_day_text("day"), "token", (F.col("gap_sum") / F.col("pairs")).alias("avg_price_difference"))


def _spread_blocks(legs: DataFrame, side: DataFrame, broadcast_max_rows: int, bound_by: DataFrame) -> DataFrame:
    """``spread_join`` of the blocks of legs and prices."""
    left, right = in_blocks(legs, "trade_price", "m"), in_blocks(side, "external_price", "n").drop("salt")
    if within_bound(side, broadcast_max_rows, bound_by):
        return left.join(F.broadcast(right), ["slot", "token"])
    return left.join(_salt_copies(right).hint("merge"), ["slot", "token", "salt"])


def _salt_copies(side: DataFrame) -> DataFrame:
    return side.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def price_gap_of_token(trades: DataFrame, prices: DataFrame, token: str, mapping=None, **options) -> DataFrame:
    """``price_gap_daily`` of one token.  Trades without it on either side and prices of other
    coins are dropped in the scan, before the trades are unpivoted."""
    trades = trades.where((F.col("sell_token") == token) | (F.col("buy_token") == token))
    if not isinstance(mapping, DataFrame):
        coins = [c for c, t in (COIN_TOKENS if mapping is None else mapping).items() if t == token]
        prices = prices.where(F.col("coin").isin(coins))
    return price_gap_daily(trades, prices, mapping=mapping, **options).where(F.col("token") == token)


def spread_join(legs: DataFrame, side: DataFrame, broadcast_max_rows: int, bound_by: DataFrame) -> DataFrame:
    """Legs and prices of one (slot, token): broadcast under the bound, else salted."""
    keys = ["slot", "token"]
    if within_bound(side, broadcast_max_rows, bound_by):
        return legs.join(F.broadcast(side), keys)
    salted = legs.withColumn("salt", F.pmod(F.xxhash64("trade_price"), F.lit(SALTS)))
    return salted.join(_salt_copies(side).hint("merge"), [*keys, "salt"])


def _day_text(day_col: str):
    return F.date_from_unix_date(F.col(day_col)).cast("string").alias("date")


def left_join_counts(trades: DataFrame, prices: DataFrame, mode: str = "12h",
                     mapping=None,
                     broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The view's trades-to-prices left join, counted per day of the hour key.

    Columns: date, joined_rows (rows of the left join), unmatched_trades (trades with
    no price row in their key), mapped_rows (joined rows whose coin maps to a token),
    leg_rows (joined rows whose token is the trade's buy or sell token).
    """
    t = trades.select(hour_slot("block_time", mode).alias("slot"), "sell_token", "buy_token")
    keyed = keyed_prices(prices, mode, mapping)
    counts = keyed.groupBy("slot", "token").agg(F.count(F.lit(1)).alias("n"))
    j = trade_price_left_join(t, counts, broadcast_max_rows, bound_by=keyed)
    n = F.coalesce(F.col("n"), F.lit(0))
    unmatched = F.col("n").isNull()
    is_leg = (F.col("token") == F.col("sell_token")) | (F.col("token") == F.col("buy_token"))
    counted = j.groupBy(slot_day("slot", mode).alias("day")).agg(
        F.sum(F.when(unmatched, F.lit(1)).otherwise(n)).cast("long").alias("joined_rows"),
        F.sum(F.when(unmatched, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("unmatched_trades"),
        F.sum(F.when(F.col("token").isNotNull(), n).otherwise(F.lit(0))).cast("long").alias("mapped_rows"),
        F.sum(F.when(F.coalesce(is_leg, F.lit(False)), n).otherwise(F.lit(0))).cast("long").alias("leg_rows"),
    )
    return counted.select(_day_text("day"), "joined_rows", "unmatched_trades", "mapped_rows", "leg_rows")


def leg_summary(pairs: DataFrame, mode: str = "12h", weight: str | None = None, legs: str | None = None) -> DataFrame:
    """(leg, price) pairs aggregated per (hour key, token); ``weight`` names the multiplicity of
    the price, ``legs`` that of the leg, whose amounts are then sums (``legs.counted_legs``).

    Groups on the integer slot and renders the hour-key text on the aggregated rows.
    """
    n = F.col(weight) if weight else F.lit(1).cast("long")
    rows = F.col(legs) * n if legs else n

    def mean(c: str):
        return F.sum(F.col(c) * rows) / F.sum(F.when(F.col(c).isNotNull(), rows))

    agg = pairs.groupBy("slot", "token").agg(
        F.sum(rows).alias("n_rows"),
        F.sum(F.col("amount") * n).alias("sum_amount"),
        mean("trade_price").alias("avg_trade_price"),
        mean("price_difference").alias("avg_price_difference"),
        F.sum(F.col("external_value_usd") * n).alias("sum_external_value_usd"),
        F.sum(F.col("usd_trade_value") * n).alias("sum_usd_trade_value"),
    )
    return agg.select(hour_text_from_slot("slot", mode).alias("datetime"), *[c for c in agg.columns if c != "slot"])
