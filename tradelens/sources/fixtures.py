"""The driver's ``events`` table mapped onto the two staging inputs.

``events`` is the only driver table with a time of day, so it carries the hour
join: purchases and signups become trades (signups in the other direction),
views, clicks and errors become market prices of three coins.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import wall_clock_millis

# Fixed values of the mapping.
TRADE_EVENT_TYPES = ("purchase", "signup")
DEFAULT_DIRECTION_EVENT = "purchase"          # buys WETH, sells USDC
PRICE_EVENT_COINS = {"view": "ethereum", "click": "usd-coin", "error": "other"}
TOKEN_PAIR = "USDC-WETH"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def k_of(props="props"):
    """The ``k`` field of the JSON text ``props`` (``{"k": <number>}``) as double; null if it is
    missing or no number."""
    p = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(p, "$.k").try_cast("double")


def _k(events: DataFrame):
    return k_of(events["props"])


def trades_from_events(events: DataFrame) -> DataFrame:
    """Trades in the staging layout (without ``id``)."""
    k = _k(events)
    default = F.col("event_type") == DEFAULT_DIRECTION_EVENT
    return (events.where(F.col("event_type").isin(*TRADE_EVENT_TYPES))
            .select(
                F.to_date("ts").alias("block_date"),
                F.col("ts").cast("timestamp_ntz").alias("block_time"),
                F.col("user_id").cast("string").alias("tx_hash"),
                F.lit(TOKEN_PAIR).alias("token_pair"),
                F.col("event_type").alias("order_type"),
                (k >= 50).alias("partial_fill"),
                F.when(default, F.lit("USDC")).otherwise(F.lit("WETH")).alias("sell_token"),
                F.when(default, F.lit("WETH")).otherwise(F.lit("USDC")).alias("buy_token"),
                (k + 2).alias("units_sold"),
                F.col("value").alias("units_bought"),
                F.col("value").alias("sell_value_usd"),
                (F.col("value") * (k + 1)).alias("usd_value"),
                (F.col("value") / (k + 2)).alias("sell_price"),
                (k + 1).alias("buy_price"),
            ))


def coin_of(event_type="event_type"):
    """Coin id of a price event."""
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    coin = None
    for ev, c in PRICE_EVENT_COINS.items():
        coin = F.when(et == ev, F.lit(c)) if coin is None else coin.when(et == ev, F.lit(c))
    return coin


def coin_prices_from_events(events: DataFrame) -> DataFrame:
    """Hourly-style market prices in the staging layout (without ``id``)."""
    coin = coin_of()
    return (events.where(F.col("event_type").isin(*PRICE_EVENT_COINS))
            .select(
                # NTZ text is 'yyyy-MM-dd HH:mm:ss[.ffffff]': whole seconds, zone-free.
                F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), 1, 19).alias("date_time"),
                F.col("value").alias("prices"),
                (F.col("value") * 1000).alias("market_cap"),
                (F.col("value") * 10).alias("total_volume"),
                coin.alias("coin"),
            ))


def price_points_from_events(events: DataFrame) -> DataFrame:
    """Price points as a price API returns them: (coin, ms, prices, market_cap, total_volume).

    ``ms`` keeps the event's milliseconds, so reading the points back must drop them.
    """
    return (events.where(F.col("event_type").isin(*PRICE_EVENT_COINS))
            .select(coin_of().alias("coin"),
                    wall_clock_millis("ts").alias("ms"),
                    F.col("value").alias("prices"),
                    (F.col("value") * 1000).alias("market_cap"),
                    (F.col("value") * 10).alias("total_volume")))


def fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = load_events(spark, sf_dir)
    return trades_from_events(events), coin_prices_from_events(events)
