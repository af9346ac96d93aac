"""Join, leg and aggregation semantics on hand-made rows, plus properties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import frames, price, trade
from tradelens.operators import aggregates as AG
from tradelens.operators import legs as LG
from tradelens.plans import price_gap as PG
from tradelens.sources import prices as PR


def gap_rows(df):
    return sorted((r.date, r.token, round(r.avg_price_difference, 9)) for r in df.collect())


def test_12h_folding_doubles_matches(spark):
    t, p = frames(spark, [trade("2024-01-05 03:10:00")],
                  [price("2024-01-05 03:20:00", "ethereum", 1.0), price("2024-01-05 15:20:00", "ethereum", 3.0)])
    assert LG.leg_price_pairs(LG.side_legs(t, "buy", "12h"), p, "12h").count() == 2
    assert LG.leg_price_pairs(LG.side_legs(t, "buy", "24h"), p, "24h").count() == 1


def test_midnight_meets_noon_in_12h_only(spark):
    t, p = frames(spark, [trade("2024-01-05 00:31:00")], [price("2024-01-05 12:31:00", "ethereum", 1.0)])
    assert [r.date for r in PG.price_gap_daily(t, p, "12h").collect()] == ["2024-01-05"]
    assert PG.price_gap_daily(t, p, "24h").count() == 0


def test_gap_value_and_unknown_coin(spark):
    # buy WETH at 3, market 1 -> 25; the 'other' coin row is ignored.
    t, p = frames(spark, [trade("2024-01-05 10:00:00", buy_price=3.0, sell_price=1.0)],
                  [price("2024-01-05 10:30:00", "ethereum", 1.0), price("2024-01-05 10:40:00", "other", 7.0)])
    assert gap_rows(PG.price_gap_daily(t, p)) == [("2024-01-05", "WETH", 25.0)]
    assert gap_rows(PG.price_gap_daily(t, p, plan="union")) == [("2024-01-05", "WETH", 25.0)]


def test_trade_without_price_is_unmatched(spark):
    t, p = frames(spark, [trade("2024-01-05 10:00:00"), trade("2024-01-06 10:00:00")],
                  [price("2024-01-05 10:30:00", "ethereum", 1.0), price("2024-01-05 10:31:00", "other", 1.0)])
    got = {r.date: r for r in PG.left_join_counts(t, p).collect()}
    assert (got["2024-01-05"].joined_rows, got["2024-01-05"].unmatched_trades,
            got["2024-01-05"].mapped_rows, got["2024-01-05"].leg_rows) == (2, 0, 1, 1)
    assert (got["2024-01-06"].joined_rows, got["2024-01-06"].unmatched_trades) == (1, 1)
    assert PG.price_gap_daily(t, p).where(F.col("date") == "2024-01-06").count() == 0


def test_null_tx_hash_and_tx_on_two_days(spark):
    t, _ = frames(spark, [trade("2024-01-05 10:00:00", tx_hash=None), trade("2024-01-05 11:00:00", tx_hash="a"),
                          trade("2024-01-06 10:00:00", tx_hash="a")], [])
    summary = {r.block_date.isoformat(): r.no_txn for r in AG.daily_trade_summary(t).collect()}
    assert summary == {"2024-01-05": 1, "2024-01-06": 1}
    head = AG.headline_totals_of_trades(t).first()
    assert (head.no_trades, head.no_trades_distinct) == (2, 1)


def test_headline_rounds_half_even(spark):
    t, _ = frames(spark, [trade("2024-01-05 10:00:00", units_bought=1.25), trade("2024-01-05 11:00:00", units_bought=1.25)], [])
    assert AG.headline_totals(AG.daily_trade_summary(t)).first().units_bought == 2


def test_zero_price_sum_raises(spark):
    t, p = frames(spark, [trade("2024-01-05 10:00:00", buy_price=0.0)], [price("2024-01-05 10:30:00", "ethereum", 0.0)])
    with pytest.raises(PySparkException):
        PG.price_gap_daily(t, p).collect()


def test_document_without_prices_gives_no_rows(spark):
    docs = spark.createDataFrame([("ethereum", '{"error": "x"}'),
                                  ("ethereum", '{"prices": [[1728691391999, 2.0]], "market_caps": [[1728691391999, 3.0]],'
                                               ' "total_volumes": [[1728691391999, 4.0]]}')], "coin string, doc string")
    rows = PR.explode_price_docs(PR.parse_price_docs(docs)).collect()
    assert [(r.coin, r.date_time, r.prices, r.market_cap, r.total_volume) for r in rows] == \
        [("ethereum", "2024-10-12 00:03:11", 2.0, 3.0, 4.0)]


def test_unequal_arrays_raise(spark):
    docs = spark.createDataFrame([("ethereum", '{"prices": [[1,2],[2,3],[3,4]], "market_caps": [[1,2],[2,3]],'
                                               ' "total_volumes": [[1,2],[2,3],[3,4]]}')], "coin string, doc string")
    with pytest.raises(PySparkException):
        PR.explode_price_docs(PR.parse_price_docs(docs)).collect()


def test_series_and_one_token(spark):
    t, p = frames(spark, [trade("2024-01-06 10:00:00"), trade("2024-01-05 10:00:00")],
                  [price("2024-01-05 10:30:00", "ethereum", 1.0), price("2024-01-06 10:30:00", "usd-coin", 1.0),
                   price("2024-01-06 10:31:00", "ethereum", 1.0)])
    gap = PG.price_gap_daily(t, p)
    assert sorted(r.token for r in AG.token_list(gap).collect()) == ["USDC", "WETH"]
    weth = [r.date.isoformat() for r in AG.series_for_token(gap, "WETH").collect()]
    assert weth == ["2024-01-05", "2024-01-06"]
    seq = [(r.token, r.seq, r.date.isoformat()) for r in AG.token_series(gap).orderBy("token", "seq").collect()]
    assert seq == [("USDC", 1, "2024-01-06"), ("WETH", 1, "2024-01-05"), ("WETH", 2, "2024-01-06")]


_hours = st.integers(min_value=0, max_value=47)
_prices = st.sampled_from([0.5, 1.0, 1.5, 2.0, 3.25])
_coins = st.sampled_from(["ethereum", "usd-coin", "other"])


def _ts(h, m):
    return f"2024-01-{5 + h // 24:02d} {h % 24:02d}:{m:02d}:00"


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(trades=st.lists(st.tuples(_hours, st.integers(0, 59), _prices, _prices, st.booleans()), min_size=1, max_size=12),
       prices=st.lists(st.tuples(_hours, st.integers(0, 59), _coins, _prices), min_size=1, max_size=12))
def test_single_join_equals_union_form(spark, trades, prices):
    """Property: the unpivoted single join gives the view's union-form result, both key modes."""
    rows_t = [trade(_ts(h, m), sell_price=sp, buy_price=bp,
                    sell_token="USDC" if d else "WETH", buy_token="WETH" if d else "USDC")
              for h, m, sp, bp, d in trades]
    rows_p = [price(_ts(h, m), c, v) for h, m, c, v in prices]
    t, p = frames(spark, rows_t, rows_p)
    for mode in ("12h", "24h"):
        assert gap_rows(PG.price_gap_daily(t, p, mode)) == gap_rows(PG.price_gap_daily(t, p, mode, plan="union"))
    # 24h pairs are a subset of 12h pairs.
    def pairs(mode):
        return LG.leg_price_pairs(LG.legs_union_all(t, mode), p, mode).count()
    assert pairs("24h") <= pairs("12h")


def test_hot_coin_hour_is_split_into_bounded_documents(spark):
    points = spark.range(50).select(F.lit("ethereum").alias("coin"), (F.lit(1704067200000) + F.col("id") * 1000).alias("ms"),
                                    F.col("id").cast("double").alias("prices"), F.lit(1.0).alias("market_cap"),
                                    F.lit(2.0).alias("total_volume"))
    docs = PR.price_docs_from_prices(points, max_points=8)
    sizes = [r.n for r in PR.parse_price_docs(docs).select(F.size("prices").alias("n")).collect()]
    assert sum(sizes) == 50 and max(sizes) <= 8
    assert docs.select("coin", "doc_hour", "chunk").distinct().count() == len(sizes)
    equal = points.select("coin", F.lit(1704067200000).alias("ms"), F.lit(1.0).alias("prices"), "market_cap", "total_volume")
    sizes = [r.n for r in PR.parse_price_docs(PR.price_docs_from_prices(equal, max_points=8)).select(F.size("prices").alias("n")).collect()]
    assert sum(sizes) == 50 and max(sizes) <= 8   # equal points do not share one document
    back = PR.explode_price_docs(PR.parse_price_docs(docs))
    assert sorted(r.prices for r in back.collect()) == [float(i) for i in range(50)]


def test_sum_of_daily_distinct_counts_bounds_the_global_distinct(spark):
    from conftest import SF_MID
    from tradelens.sources import fixtures as FX
    trades, _ = FX.fixture_tables(spark, SF_MID)
    head = AG.headline_totals_of_trades(trades).first()
    summary = AG.headline_totals(AG.daily_trade_summary(trades)).first()
    assert {k: head[k] for k in summary.asDict()} == summary.asDict()
    assert head.no_trades >= head.no_trades_distinct > 0


def test_null_prices_are_ignored_like_avg(spark):
    t, p = frames(spark, [trade("2024-01-05 10:00:00", buy_price=3.0), trade("2024-01-05 10:10:00", buy_price=None)],
                  [price("2024-01-05 10:30:00", "ethereum", 1.0), ("2024-01-05 10:40:00", None, None, None, "ethereum")])
    assert gap_rows(PG.price_gap_daily(t, p)) == [("2024-01-05", "WETH", 25.0)]
    assert gap_rows(PG.price_gap_daily(t, p, plan="union")) == [("2024-01-05", "WETH", 25.0)]


_maybe_prices = st.one_of(st.none(), _prices)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(trades=st.lists(st.tuples(_hours, st.integers(0, 59), _prices, _prices, st.booleans()), min_size=1, max_size=10),
       prices=st.lists(st.tuples(_hours, st.integers(0, 59), _coins, _maybe_prices), min_size=1, max_size=14))
def test_compressed_view_forms_equal_the_row_form(spark, trades, prices):
    """Property: weighted view rows and per-leg price sums give the row form's aggregates."""
    rows_t = [trade(_ts(h, m), sell_price=sp, buy_price=bp,
                    sell_token="USDC" if d else "WETH", buy_token="WETH" if d else "USDC")
              for h, m, sp, bp, d in trades]
    rows_p = [price(_ts(h, m), c, v) if v is not None else (_ts(h, m), None, None, None, c) for h, m, c, v in prices]
    t, p = frames(spark, rows_t, rows_p)

    def summary(df):
        rows = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()]
        return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    for side in ("sell", "buy"):
        row_form = PG.leg_summary(LG.leg_price_pairs(LG.side_legs(t, side), p))
        weighted = PG.leg_summary(LG.weighted_pairs(LG.side_legs(t, side), p), weight="n")
        assert summary(row_form.select(*sorted(row_form.columns))) == summary(weighted.select(*sorted(row_form.columns)))
    rows = LG.leg_price_pairs(LG.legs_union_all(t), p).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("a"), F.sum("external_value_usd").alias("v"))
    sums = LG.legs_with_price_sums(LG.legs_union_all(t), p).groupBy("token").agg(
        F.sum("n").alias("n"), F.sum(F.col("amount") * F.col("n")).alias("a"),
        F.sum(F.col("amount") * F.col("sum_price")).alias("v"))
    assert summary(rows) == summary(sums)


def test_zero_price_sum_can_be_skipped(spark):
    t, p = frames(spark, [trade("2024-01-05 10:00:00", buy_price=0.0), trade("2024-01-05 10:05:00", buy_price=3.0)],
                  [price("2024-01-05 10:30:00", "ethereum", 0.0), price("2024-01-05 10:31:00", "ethereum", 1.0)])
    # pairs (0,0) skipped; (0,1) -> -25, (3,0) -> 25, (3,1) -> 25
    got = gap_rows(PG.price_gap_daily(t, p, on_zero="null"))
    assert got == [("2024-01-05", "WETH", round(25 / 3, 9))]


def test_dedupe_prices_avg_meets_one_price_per_key(spark):
    t, p = frames(spark, [trade("2024-01-05 10:00:00", buy_price=3.0)],
                  [price("2024-01-05 10:30:00", "ethereum", 1.0), price("2024-01-05 10:40:00", "ethereum", 5.0)])
    # every row: (25 + -12.5) / 2 = 6.25; averaged price 3 -> 0
    assert gap_rows(PG.price_gap_daily(t, p)) == [("2024-01-05", "WETH", 6.25)]
    assert gap_rows(PG.price_gap_daily(t, p, dedupe_prices="avg")) == [("2024-01-05", "WETH", 0.0)]


def test_flagship_result_does_not_depend_on_the_session_zone(spark):
    from conftest import SF_SMALL
    from tradelens.sources import fixtures as FX

    def run():
        trades, prices = FX.fixture_tables(spark, SF_SMALL)
        return gap_rows(PG.price_gap_daily(trades, prices)), gap_rows(PG.price_gap_daily(trades, prices, plan="union"))
    utc = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_coin_lookup_table_equals_the_case_mapping(spark):
    from conftest import SF_SMALL
    from tradelens.sources import fixtures as FX
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    lookup = spark.createDataFrame([("ethereum", "WETH"), ("usd-coin", "USDC")], "coin string, token string")
    for plan in ("single_join", "union"):
        assert gap_rows(PG.price_gap_daily(trades, prices, plan=plan, mapping=lookup)) == \
            gap_rows(PG.price_gap_daily(trades, prices, plan=plan))
    def counts(df):
        return sorted(df.collect())
    assert counts(PG.left_join_counts(trades, prices, mapping=lookup)) == counts(PG.left_join_counts(trades, prices))
