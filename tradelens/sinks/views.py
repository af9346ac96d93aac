"""The two result views as Spark SQL text, published with CREATE OR REPLACE VIEW.

The price-gap view is written in the single-join form: each trade unpivoted into
its two legs, joined once on (hour slot, token).  Catalyst plans it like the
DataFrame version in ``plans.price_gap``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import COIN_TOKENS

# The gap over the sum of both prices, by what a zero sum does whatever the session's ANSI mode
# (``functions.scalars.price_gap``).
_TOTAL = {
    "raise": ("CASE WHEN trade_price + external_price = 0 "
              "THEN CAST(raise_error('trade price and market price sum to zero') AS DOUBLE) "
              "ELSE trade_price + external_price END"),
    "null": "nullif(trade_price + external_price, 0D)",
    "ieee": "nullif(trade_price + external_price, 0D)",
}
_GAP_EXPR = {
    "quarter": "((trade_price - external_price) / ({total}) / 2) * 100",
    "symmetric_pct": "(trade_price - external_price) / (({total}) / 2) * 100",
}


def _gap_expr(gap: str, on_zero: str) -> str:
    expr = _GAP_EXPR[gap].format(total=_TOTAL[on_zero])
    if on_zero != "ieee":
        return expr
    return ("CASE WHEN trade_price + external_price = 0 "
            f"THEN (trade_price - external_price) * CAST('Infinity' AS DOUBLE) ELSE {expr} END")


def _token_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in COIN_TOKENS.items())
    return f"CASE {whens} END"


def _slot(ts_sql: str, n: int) -> str:
    return f"unix_date(to_date({ts_sql})) * {n} + hour({ts_sql}) % {n}"


def price_gap_view_sql(trades: str, prices: str, mode: str = "12h", gap: str = "quarter", on_zero: str = "raise") -> str:
    """The price-gap view.  It names no join strategy: a view outlives the sizes measured when
    it is published, so AQE decides from those it meets at read time.  Equal legs, like equal
    prices, are counted before the join."""
    n = 12 if mode == "12h" else 24
    difference = _gap_expr(gap, on_zero)
    t_ts = "CAST(block_time AS TIMESTAMP_NTZ)"
    p_ts = "CAST(date_time AS TIMESTAMP_NTZ)"
    return f"""
WITH legs AS (
  SELECT slot, token, trade_price, count(*) AS m
  FROM (SELECT {_slot(t_ts, n)} AS slot, leg.token, leg.trade_price
        FROM {trades}
        LATERAL VIEW inline(array(named_struct('token', sell_token, 'trade_price', sell_price),
                                  named_struct('token', buy_token, 'trade_price', buy_price))) leg AS token, trade_price)
  GROUP BY slot, token, trade_price
), px AS (
  SELECT slot, token, external_price, count(*) AS n
  FROM (SELECT {_slot(p_ts, n)} AS slot, {_token_case('coin')} AS token, prices AS external_price
        FROM {prices})
  WHERE token IS NOT NULL
  GROUP BY slot, token, external_price
), days AS (
  SELECT CAST(floor(legs.slot / {n}) AS INT) AS day, legs.token AS token,
         sum(({difference}) * (legs.m * px.n)) AS gap_sum,
         sum(CASE WHEN ({difference}) IS NOT NULL THEN legs.m * px.n END) AS pairs
  FROM legs JOIN px ON legs.slot = px.slot AND legs.token = px.token
  GROUP BY CAST(floor(legs.slot / {n}) AS INT), legs.token
)
SELECT CAST(date_from_unix_date(day) AS STRING) AS date, token,
       gap_sum / pairs AS avg_price_difference
FROM days"""


def summary_view_sql(trades: str) -> str:
    return f"""
SELECT block_date, token_pair,
       count(DISTINCT tx_hash) AS no_txn,
       sum(usd_value) AS total_usd_value_bought,
       sum(sell_value_usd) AS total_usd_value_sold,
       sum(units_sold) AS total_units_sold,
       sum(units_bought) AS total_units_bought,
       avg(buy_price) AS avg_buy_price,
       avg(sell_price) AS avg_sell_price
FROM {trades}
GROUP BY block_date, token_pair"""


def publish_views(spark: SparkSession, trades: str, prices: str, target: str | None = None,
                  mode: str = "12h", gap: str = "quarter", temporary: bool = False,
                  prefix: str = "", on_zero: str = "raise") -> dict[str, DataFrame]:
    """Create or replace ``price_gap_daily`` and ``trade_summary_daily``.

    ``target`` is the database of persistent views; ``temporary=True`` publishes
    session views instead (allowed over temporary inputs), their names preceded by ``prefix``.
    """
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    place = "" if temporary or not target else f"{target}."
    names = {"price_gap_daily": price_gap_view_sql(trades, prices, mode, gap, on_zero),
             "trade_summary_daily": summary_view_sql(trades)}
    out = {}
    for name, body in names.items():
        spark.sql(f"CREATE OR REPLACE {kind} {place}{prefix}{name} AS {body}")
        out[name] = spark.table(f"{place}{prefix}{name}")
    return out
