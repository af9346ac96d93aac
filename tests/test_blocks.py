"""Legs and prices meet in blocks: every pair is formed, in few joined rows."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import frames, price, trade
from tradelens import jobs as JB
from tradelens.operators import legs as LG
from tradelens.operators.blocks import BLOCK, gap_sum, in_blocks, pair_count
from tradelens.plans import price_gap as PG


def _price(time, coin, value):
    return (time, value, 1.0, 1.0, coin)


def _odd_hour(spark, zero=False):
    """One hour with repeated, missing, negative and infinite prices, a leg without a price, and
    an hour whose prices are all missing."""
    trades = [trade("2024-01-05 10:00:00", sell_price=i / 3 - 1, buy_price=None if i % 5 == 0 else 0.5 + i % 4, tx_hash=str(i))
              for i in range(23)]
    trades += [trade("2024-01-06 10:00:00"), trade("2024-01-07 10:00:00", sell_price=-2.0, buy_price=3.0)]
    prices = [_price("2024-01-05 10:30:00", c, None if i % 6 == 0 else 1.25 + i % 9) for i in range(31) for c in ("ethereum", "usd-coin")]
    prices += [_price("2024-01-06 10:10:00", "ethereum", None), _price("2024-01-07 10:10:00", "ethereum", math.inf),
               _price("2024-01-07 10:20:00", "usd-coin", 2.0 if zero else 1.0)]
    return frames(spark, trades, prices)


def _row_form(trades, prices, mode, gap, on_zero):
    pairs = LG.leg_price_pairs(LG.legs_union_all(trades, mode), prices, mode, gap, on_zero=on_zero)
    day = F.substring(PG.hour_text_from_slot("slot", mode), 1, 10).alias("date")
    return pairs.groupBy(day, "token").agg(F.avg("price_difference").alias("avg_price_difference"))


def _rows(df):
    return sorted(((r.date, r.token, None if r.avg_price_difference is None else format(r.avg_price_difference, ".9g"))
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("plan", ["single_join", "union"])
@pytest.mark.parametrize("max_rows", [0, 1_000_000])
@pytest.mark.parametrize(("gap", "on_zero", "zero"), [("quarter", "raise", False), ("quarter", "null", True),
                                                      ("symmetric_pct", "ieee", True), ("quarter", "ieee", True)])
def test_blocks_give_the_average_of_all_pairs(spark, plan, max_rows, gap, on_zero, zero):
    trades, prices = _odd_hour(spark, zero)
    got = _rows(PG.price_gap_daily(trades, prices, plan=plan, gap=gap, on_zero=on_zero, broadcast_max_rows=max_rows))
    assert got == _rows(_row_form(trades, prices, "12h", gap, on_zero))
    assert ("2024-01-06", "WETH", None) in got and len(got) == 5


@pytest.mark.parametrize("plan", ["single_join", "union"])
def test_a_zero_sum_raises_and_an_idle_place_does_not(spark, plan):
    trades, prices = _odd_hour(spark, zero=True)
    with pytest.raises(PySparkException, match="sum to zero"):
        PG.price_gap_daily(trades, prices, plan=plan).collect()


def test_a_block_pair_is_one_joined_row(spark):
    """40 legs by 44 prices: every pair counts, and no more than two part-filled blocks per salt are joined."""
    trades, prices = frames(spark, [trade("2024-01-05 10:00:00", buy_price=2.0, tx_hash=str(i)) for i in range(40)],
                            [price("2024-01-05 10:30:00", "ethereum", 3.0) for _ in range(44)])
    legs = LG.side_legs(trades, "buy")
    packed = LG.leg_price_pairs(legs, prices, packed=True)
    assert packed.count() == 40 * 44 // BLOCK**2
    got = packed.agg(F.sum(gap_sum()), F.sum(pair_count()), F.sum("external_value_usd")).first()
    want = LG.leg_price_pairs(legs, prices).agg(F.sum("price_difference"), F.count("*"), F.sum("external_value_usd")).first()
    assert [float(x) for x in got] == pytest.approx([float(x) for x in want])


def test_blocks_hold_every_row_once(spark):
    rows = spark.range(1000).select(F.lit(1).alias("slot"), F.lit("WETH").alias("token"), F.lit(1).cast("long").alias("n"),
                                    F.when(F.col("id") % 10 != 0, F.col("id") / 7).alias("external_price"))
    blocks = in_blocks(rows, "external_price", "n").persist()
    assert blocks.agg(F.sum("n")).first()[0] == 900
    held = [r for i in range(BLOCK) for r in blocks.where(f"n_{i} > 0").select(f"external_price_{i}").collect()]
    assert sorted(r[0] for r in held) == sorted(i / 7 for i in range(1000) if i % 10)
    blocks.unpersist()


@pytest.mark.parametrize("plan", ["single_join", "union"])
def test_the_pairs_are_summed_outside_the_loop_of_the_join(spark, plan):
    """The plan joins blocks, and its pairs are part of the aggregate, not of a projection."""
    trades, prices = _odd_hour(spark)
    text = PG.price_gap_daily(trades, prices, plan=plan)._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert f"external_price_{BLOCK - 1}#" in text.split("Join Inner")[0] and "try_divide" not in text.split("Join Inner")[1]


def test_a_refresh_forms_its_pairs_in_blocks(spark, tmp_path, monkeypatch):
    """Both materialized results are written by one refresh; its gap joins blocks and is the
    average of all pairs of the refreshed days, its summary that of their trades."""
    trades, prices = _odd_hour(spark, zero=True)
    plans, write = {}, JB.replace_days

    def seen(session, df, path, column, days):
        plans[column] = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
        write(session, df, path, column, days)

    monkeypatch.setattr(JB, "replace_days", seen)
    paths = (str(tmp_path / "summary"), str(tmp_path / "gap"))
    JB.refresh_daily_results(spark, trades, prices, ["2024-01-05", "2024-01-07"], *paths, on_zero="ieee")
    assert f"external_price_{BLOCK - 1}#" in plans["date"].split("Join Inner")[0] and "Join" not in plans["block_date"]
    summary, gap = JB.read_daily_results(spark, *paths)
    assert _rows(gap) == [r for r in _rows(_row_form(trades, prices, "12h", "quarter", "ieee")) if r[0] != "2024-01-06"]
    got = {str(r.block_date): (r.no_txn, r.total_units_sold) for r in summary.collect()}
    assert got == {"2024-01-05": (23, 23.0), "2024-01-07": (1, 1.0)}
