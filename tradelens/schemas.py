"""Declared schemas of the staging tables and the price-history document."""

from pyspark.sql import types as T

# Staging table of swap trades.  ``id`` is the content hash of the other columns.
TRADES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("block_date", T.DateType()),
    T.StructField("block_time", T.TimestampNTZType()),
    T.StructField("tx_hash", T.StringType()),
    T.StructField("token_pair", T.StringType()),
    T.StructField("order_type", T.StringType()),
    T.StructField("partial_fill", T.BooleanType()),
    T.StructField("sell_token", T.StringType()),
    T.StructField("buy_token", T.StringType()),
    T.StructField("units_sold", T.DoubleType()),
    T.StructField("units_bought", T.DoubleType()),
    T.StructField("sell_value_usd", T.DoubleType()),
    T.StructField("usd_value", T.DoubleType()),
    T.StructField("sell_price", T.DoubleType()),
    T.StructField("buy_price", T.DoubleType()),
])

# Staging table of hourly market prices per coin.  ``date_time`` is UTC text.
COIN_PRICES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("date_time", T.StringType()),
    T.StructField("prices", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("coin", T.StringType()),
])

# Price-history document: three parallel ``[[unix_ms, value], ...]`` arrays.
PRICE_DOC = T.StructType([
    T.StructField("prices", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("market_caps", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("total_volumes", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

PRICE_DOC_DDL = ("prices array<array<double>>, market_caps array<array<double>>, "
                 "total_volumes array<array<double>>")

# Price documents that could not be loaded: the landed file, why, and the document's text.
REJECTED_DOCS = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "coin", "file", "reason", "doc")])

# The load ledger: one row when a window's load starts, one when it is done.
LEDGER = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("first_day", T.DateType()),
    T.StructField("last_day", T.DateType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("trade_rows", T.LongType()),
    T.StructField("new_trades", T.LongType()),
    T.StructField("price_rows", T.LongType()),
    T.StructField("new_prices", T.LongType()),
])


def without_id(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "id"])
