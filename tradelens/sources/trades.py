"""Trade scans with the load windows of the initial and the daily load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_before, month_start
from ..schemas import TRADES, without_id

# Fixed value: how trade documents write times.
_DOC_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _as_of(as_of) -> F.Column:
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def trade_window(trades: DataFrame, buy_token: str = "WETH", sell_token: str = "USDC",
                 lo=None, hi_exclusive=None) -> DataFrame:
    """Trades of one direction with ``lo <= block_date < hi_exclusive``.

    The token and date predicates reach the Parquet scan (and prune ``block_date``
    partitions of a partitioned table)."""
    cond = (F.col("buy_token") == buy_token) & (F.col("sell_token") == sell_token)
    if lo is not None:
        cond = cond & (F.col("block_date") >= lo)
    if hi_exclusive is not None:
        cond = cond & (F.col("block_date") < hi_exclusive)
    return trades.where(cond)


def trades_month_to_date(trades: DataFrame, as_of, buy_token: str = "WETH",
                         sell_token: str = "USDC") -> DataFrame:
    """Initial load: from the first of ``as_of``'s month up to the day before ``as_of``."""
    d = _as_of(as_of)
    return trade_window(trades, buy_token, sell_token, lo=month_start(d), hi_exclusive=d)


def trades_prev_day(trades: DataFrame, as_of, buy_token: str = "WETH",
                    sell_token: str = "USDC") -> DataFrame:
    """Daily load: the day before ``as_of``."""
    d = _as_of(as_of)
    return trades.where((F.col("buy_token") == buy_token) & (F.col("sell_token") == sell_token)
                        & (F.col("block_date") == days_before(d, 1)))


def trade_docs(trades: DataFrame) -> DataFrame:
    """Trades as documents ``(key, day, doc)``: the direction ``<sell>-<buy>``, the date, a JSON row."""
    row = F.to_json(F.struct(*without_id(TRADES).fieldNames()), _DOC_TIMES)
    return trades.select(F.concat_ws("-", "sell_token", "buy_token").alias("key"), F.col("block_date").alias("day"), row.alias("doc"))


def parse_trade_docs(docs: DataFrame) -> DataFrame:
    """Documents (``doc``) -> trades; a document that is no JSON row of the layout fails the read."""
    return docs.select(F.from_json("doc", without_id(TRADES), _DOC_TIMES | {"mode": "FAILFAST"}).alias("t")).select("t.*")
