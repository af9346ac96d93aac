"""Plan checks: no Python in any plan, one price join, pushdown, checked broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tradelens.operators import legs as LG
from tradelens.operators.joins import checked_broadcast
from tradelens.plans import price_gap as PG
from tradelens.session import scratch_path
from tradelens.sources import fixtures as FX


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_single_join_plan_has_one_join_and_prunes_columns(spark):
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    text = plan_text(PG.price_gap_daily(trades, prices))
    assert text.count("Join") == 1
    assert "BroadcastHashJoin" in text
    # Only the needed event columns are read.
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in text \
        or "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_event_type_filter_reaches_the_scan(spark):
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    text = plan_text(PG.price_gap_daily(trades, prices))
    assert "PushedFilters: [In(event_type" in text


def test_union_plan_unites_the_legs_before_one_join(spark):
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    text = plan_text(PG.price_gap_daily(trades, prices, plan="union"))
    assert text.count("Union") == 1 and text.count("Join") == 1 and text.count("FileScan") == 3


def test_broadcast_only_under_the_bound(spark):
    small = spark.range(10)
    assert "ResolvedHint (strategy=broadcast)" in checked_broadcast(small, 10)._jdf.queryExecution().analyzed().toString()  # noqa: SLF001
    assert "broadcast" not in checked_broadcast(small, 9)._jdf.queryExecution().analyzed().toString()  # noqa: SLF001
    big_side = PG.price_gap_daily(*FX.fixture_tables(spark, SF_SMALL), broadcast_max_rows=1)
    text = plan_text(big_side)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    def rounded(df):
        return sorted((r.date, r.token, round(r.avg_price_difference, 9)) for r in df.collect())
    assert rounded(big_side) == rounded(PG.price_gap_daily(*FX.fixture_tables(spark, SF_SMALL)))


def test_hot_slot_is_spread_beyond_the_bound(spark):
    """One hour slot holds a third of the legs.  Beyond the broadcast bound the gap's join is
    salted by the leg's price, with AQE's default thresholds; the left join's hot partition is
    split by AQE."""
    from pyspark.sql import functions as F
    from tradelens.schemas import TRADES, without_id
    base = spark.range(30000).select(
        F.to_date(F.lit("2024-01-05")).alias("block_date"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-05 10:00:00"))
         .otherwise(F.concat(F.lit("2024-01-"), F.lpad(((F.col("id") % 25) + 1).cast("string"), 2, "0"),
                             F.lit(" "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":15:00")))
         .cast("timestamp_ntz").alias("block_time"),
        F.col("id").cast("string").alias("tx_hash"), F.lit("USDC-WETH").alias("token_pair"),
        F.lit("sell").alias("order_type"), F.lit(False).alias("partial_fill"),
        F.lit("USDC").alias("sell_token"), F.lit("WETH").alias("buy_token"),
        F.lit(1.0).alias("units_sold"), F.lit(1.0).alias("units_bought"), F.lit(1.0).alias("sell_value_usd"),
        F.lit(2.0).alias("usd_value"), ((F.col("id") % 7) + 1.0).alias("sell_price"), ((F.col("id") % 5) + 1.0).alias("buy_price"))
    trades = spark.createDataFrame(base.rdd, without_id(TRADES))
    prices = spark.range(2000).select(
        F.date_format(F.timestamp_add("MINUTE", F.col("id") * 17, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                      "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        ((F.col("id") % 11) + 1.0).alias("prices"), F.lit(1.0).alias("market_cap"), F.lit(1.0).alias("total_volume"),
        F.when(F.col("id") % 2 == 0, F.lit("ethereum")).otherwise(F.lit("usd-coin")).alias("coin"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = PG.left_join_counts(trades, prices, broadcast_max_rows=0)
        left_rows = sorted(left.collect())
        left_final = plan_text(left)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    shuffled = PG.price_gap_daily(trades, prices, broadcast_max_rows=0)
    got = sorted((r.date, r.token, round(r.avg_price_difference, 9)) for r in shuffled.collect())
    assert re.search(r"SortMergeJoin \[slot#\d+L?, token#\d+, salt#", plan_text(shuffled))
    # Equal legs meet before the join: the hot slot's 10,000 trades are a few distinct prices.
    hot = LG.trade_legs(trades, fields=("token", "trade_price")).groupBy("slot", "token", "trade_price").count()
    assert hot.groupBy("slot", "token").count().agg(F.max("count")).first()[0] <= 7
    want = sorted((r.date, r.token, round(r.avg_price_difference, 9))
                  for r in PG.price_gap_daily(trades, prices).collect())
    assert got == want
    # The left join (trades keep their rows) splits the hot trade partition too.
    assert "SortMergeJoin(skew=true)" in left_final and "LeftOuter" in left_final
    assert left_rows == sorted(PG.left_join_counts(trades, prices).collect())


def test_published_view_names_no_join_strategy(spark):
    """A view outlives the sizes at publishing: no hint is frozen into it, so a price table that
    has grown is not broadcast."""
    import uuid
    from tradelens.sinks import views as VW
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:6]
    trades.createOrReplaceTempView(f"pv_trades_{tag}")
    prices.createOrReplaceTempView(f"pv_prices_{tag}")
    view = VW.publish_views(spark, f"pv_trades_{tag}", f"pv_prices_{tag}", temporary=True, prefix=f"pv_{tag}_")["price_gap_daily"]
    assert "Hint" not in view._jdf.queryExecution().analyzed().toString()  # noqa: SLF001
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1")
        assert "SortMergeJoin" in plan_text(view) and "BroadcastHashJoin" not in plan_text(view)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_beyond_the_bound_no_estimate_can_broadcast(spark):
    """With Spark's default estimate-based threshold (10 MB) the hint above the bound wins."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        trades, prices = FX.fixture_tables(spark, SF_SMALL)
        assert "BroadcastHashJoin" in plan_text(PG.price_gap_daily(trades, prices))
        shuffled = PG.price_gap_daily(trades, prices, broadcast_max_rows=1)
        shuffled.collect()                      # final AQE plan, after run-time re-planning
        text = plan_text(shuffled)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_token_is_filtered_before_the_unpivot(spark):
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    odd = trades.withColumn("sell_token", F.when(F.col("tx_hash") < "3", F.lit("DAI")).otherwise(F.col("sell_token")))
    base = scratch_path(spark, "one-token")
    odd.write.parquet(f"{base}/t")
    prices.write.parquet(f"{base}/p")
    odd, prices = spark.read.parquet(f"{base}/t"), spark.read.parquet(f"{base}/p")
    plan = plan_text(PG.price_gap_of_token(odd, prices, "USDC"))
    assert "Or(EqualTo(sell_token,USDC),EqualTo(buy_token,USDC))" in plan and "EqualTo(coin,usd-coin)" in plan
    want = sorted(tuple(r) for r in PG.price_gap_daily(odd, prices).where("token = 'USDC'").collect())
    got = PG.price_gap_of_token(odd, prices, "USDC")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert PG.price_gap_of_token(odd, prices, "none such").count() == 0
    lookup = spark.createDataFrame([("usd-coin", "USDC"), ("ethereum", "WETH")], "coin string, token string")
    assert sorted(tuple(r) for r in PG.price_gap_of_token(odd, prices, "USDC", mapping=lookup).collect()) == want


@pytest.mark.parametrize("max_rows", [1, 1_000_000])
def test_token_list_forms_no_pairs(spark, max_rows):
    from tradelens.operators import aggregates as AG
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    lone = trades.withColumn("buy_token", F.when(F.col("tx_hash") < "3", F.lit("DAI")).otherwise(F.col("buy_token")))
    got = AG.tokens_with_prices(lone, prices, broadcast_max_rows=max_rows)
    text = plan_text(got)
    assert "LeftSemi" in text and text.count("Join") == 1
    assert {r.token for r in got.collect()} == {r.token for r in AG.token_list(PG.price_gap_daily(lone, prices)).collect()}
    assert AG.tokens_with_prices(lone.limit(0), prices).count() == 0
