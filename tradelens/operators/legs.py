"""Trade legs: each trade has a sell leg and a buy leg, joined to that token's price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import coin_to_token, hour_slot, market_value, price_gap
from .blocks import in_blocks
from .joins import BROADCAST_MAX_ROWS, checked_broadcast, within_bound


def with_token(prices: DataFrame, mapping=None) -> DataFrame:
    """Add ``token``, the trade symbol of each price row's ``coin`` (NULL when unmapped).

    ``mapping`` is a dict (a CASE expression, right for a handful of coins) or a
    DataFrame ``(coin, token)``: a lookup table for many coins, where a CASE with
    thousands of branches would outgrow generated code.  The lookup is joined behind
    the measured broadcast bound; a coin listed twice keeps one token.
    """
    if isinstance(mapping, DataFrame):
        lookup = mapping.select("coin", F.col("token").alias("_token")).dropDuplicates(["coin"])
        return prices.join(checked_broadcast(lookup), "coin", "left").withColumnRenamed("_token", "token")
    return prices.withColumn("token", coin_to_token("coin", mapping))


def keyed_prices(prices: DataFrame, mode: str = "12h", mapping=None) -> DataFrame:
    """Price rows -> (slot, token, external_price); unmapped coins keep a NULL token."""
    return with_token(prices, mapping).select(hour_slot("date_time", mode).alias("slot"), "token",
                                              F.col("prices").alias("external_price"))


def weighted_prices(prices: DataFrame, mode: str = "12h", mapping=None) -> DataFrame:
    """Distinct (slot, token, external_price) with their multiplicity ``n``.

    Exact pre-aggregation of the price side: a pair (leg, price) counted ``n`` times
    is one joined row of weight ``n``.  Unmapped coins are dropped here, since an
    inner join on the token could never match them.
    """
    return (mapped_prices(prices, mode, mapping)
            .groupBy("slot", "token", "external_price").agg(F.count(F.lit(1)).alias("n")))


def mapped_prices(prices: DataFrame, mode: str = "12h", mapping=None) -> DataFrame:
    """Keyed price rows of mapped coins: the input of ``weighted_prices`` (and a bound on its size)."""
    return keyed_prices(prices, mode, mapping).where(F.col("token").isNotNull())


# The trade column behind each leg field, per side.
_LEG_COLUMNS = {
    "sell": {"token": "sell_token", "amount": "units_sold", "trade_price": "sell_price", "usd_trade_value": "sell_value_usd"},
    "buy": {"token": "buy_token", "amount": "units_bought", "trade_price": "buy_price", "usd_trade_value": "usd_value"},
}
LEG_FIELDS = ("token", "amount", "trade_price", "usd_trade_value")


def _leg(side: str, fields) -> list[Column]:
    if side not in _LEG_COLUMNS:
        raise ValueError("side must be 'sell' or 'buy'")
    return [F.col(_LEG_COLUMNS[side][f]).alias(f) for f in fields]


def side_legs(trades: DataFrame, side: str, mode: str = "12h", fields: tuple[str, ...] = LEG_FIELDS) -> DataFrame:
    """The legs of one side: (slot, *fields), straight from that side's columns."""
    return trades.select(hour_slot("block_time", mode).alias("slot"), *_leg(side, fields))


def trade_legs(trades: DataFrame, mode: str = "12h", fields: tuple[str, ...] = LEG_FIELDS) -> DataFrame:
    """Unpivot each trade into its sell and buy leg (one scan, no union): (slot, side, *fields).

    Only ``fields`` are carried through the generator, so unused trade columns are
    pruned down to the Parquet scan.
    """
    both = F.array(*[F.struct(F.lit(side).alias("side"), *_leg(side, fields)) for side in _LEG_COLUMNS])
    return trades.select(hour_slot("block_time", mode).alias("slot"), F.inline(both))


def legs_union_all(trades: DataFrame, mode: str = "12h", fields: tuple[str, ...] = LEG_FIELDS) -> DataFrame:
    """The legs of both sides as ``sell legs UNION ALL buy legs``: (slot, *fields)."""
    return side_legs(trades, "sell", mode, fields).unionByName(side_legs(trades, "buy", mode, fields))


def counted_legs(legs: DataFrame) -> DataFrame:
    """Distinct (slot, token, trade_price) of legs with all ``LEG_FIELDS``: the number ``m`` of
    legs, the sums of their amounts and values."""
    return legs.groupBy("slot", "token", "trade_price").agg(
        F.count(F.lit(1)).alias("m"), F.sum("amount").alias("amount"), F.sum("usd_trade_value").alias("usd_trade_value"))


def leg_price_pairs(legs: DataFrame, prices: DataFrame, mode: str = "12h", gap: str = "quarter", mapping=None,
                    broadcast_max_rows: int = BROADCAST_MAX_ROWS, on_zero: str = "raise", packed: bool = False) -> DataFrame:
    """Every (leg, price row) pair of one (slot, token), with its gap and market value.

    The row form of the price join, many-to-many: its size is legs times prices.  The
    aggregates below and ``plans.price_gap`` give the same sums without the pairs.

    ``packed``: the same pairs, a block of legs by a block of price rows to a row: their gaps are
    summed by ``blocks.gap_sum`` and counted by ``blocks.pair_count``, and ``external_value_usd`` is
    the sum of their market values, if the legs carry an amount.
    """
    if packed:
        return _packed_pairs(legs, mapped_prices(prices, mode, mapping), broadcast_max_rows)
    side = checked_broadcast(mapped_prices(prices, mode, mapping), broadcast_max_rows)
    return legs.join(side, ["slot", "token"]).withColumns({
        "price_difference": price_gap("trade_price", "external_price", gap, on_zero),
        "external_value_usd": market_value("amount", "external_price")})


def _packed_pairs(legs: DataFrame, side: DataFrame, broadcast_max_rows: int) -> DataFrame:
    one = F.lit(1).cast("long")
    amounts = {"amount": F.sum("amount")} if "amount" in legs.columns else {}
    left = in_blocks(legs.withColumn("m", one), "trade_price", "m", **amounts).drop("salt")
    right = in_blocks(side.withColumn("n", one), "external_price", "n", price_sum=F.sum("external_price")).drop("salt")
    right = F.broadcast(right) if within_bound(side, broadcast_max_rows) else right.hint("merge")
    pairs = left.join(right, ["slot", "token"])
    return pairs.withColumn("external_value_usd", market_value("amount", "price_sum")) if amounts else pairs


def weighted_pairs(legs: DataFrame, prices: DataFrame, mode: str = "12h", gap: str = "quarter",
                   mapping=None, broadcast_max_rows: int = BROADCAST_MAX_ROWS, on_zero: str = "raise") -> DataFrame:
    """``leg_price_pairs`` as a multiset: each row stands for ``n`` equal pairs.

    Legs are joined to distinct (slot, token, price) with their multiplicity, so a price
    repeated within an hour key is one joined row of weight ``n``.  ``counted_legs`` do the
    same for the legs: a row then stands for ``m * n`` pairs.
    """
    side = checked_broadcast(weighted_prices(prices, mode, mapping), broadcast_max_rows,
                             mapped_prices(prices, mode, mapping))
    return legs.join(side, ["slot", "token"]).withColumns({
        "price_difference": price_gap("trade_price", "external_price", gap, on_zero),
        "external_value_usd": market_value("amount", "external_price")})


def price_sums(prices: DataFrame, mode: str = "12h", mapping=None) -> DataFrame:
    """Per (slot, token): the number ``n`` of price rows and their sum ``sum_price``.

    Enough for every aggregate that is linear in the market price (counts, sums of
    amount x price): joined to it, each leg gives one row instead of one per price.
    """
    return mapped_prices(prices, mode, mapping).groupBy("slot", "token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("external_price").alias("sum_price"))


def legs_with_price_sums(legs: DataFrame, prices: DataFrame, mode: str = "12h", mapping=None,
                         broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Each leg with ``n`` and ``sum_price`` of its (slot, token): one row per leg.

    ``sum(n)`` is the number of (leg, price) pairs, and ``sum(amount * sum_price)`` their
    market value, without emitting the pairs.
    """
    side = checked_broadcast(price_sums(prices, mode, mapping), broadcast_max_rows,
                             mapped_prices(prices, mode, mapping))
    return legs.join(side, ["slot", "token"])
