import datetime as dt

from tradelens.schemas import COIN_PRICES, TRADES, without_id

TRADE_SCHEMA = without_id(TRADES)
PRICE_SCHEMA = without_id(COIN_PRICES)


def trade(block_time, sell_token="USDC", buy_token="WETH", sell_price=1.0, buy_price=2.0,
          tx_hash="t1", units_sold=1.0, units_bought=1.0, token_pair="USDC-WETH"):
    ts = dt.datetime.fromisoformat(block_time)
    def mul(a, b):
        return None if a is None or b is None else a * b
    return (ts.date(), ts, tx_hash, token_pair, "sell", False, sell_token, buy_token, units_sold,
            units_bought, mul(units_sold, sell_price), mul(units_bought, buy_price), sell_price, buy_price)


def price(date_time, coin="ethereum", value=1.0):
    return (date_time, value, value * 1000, value * 10, coin)


def frames(spark, trades, prices):
    return spark.createDataFrame(trades, TRADE_SCHEMA), spark.createDataFrame(prices, PRICE_SCHEMA)
