"""Equal legs are counted before they meet the prices."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from helpers import frames, price, trade
from tradelens.operators import legs as LG
from tradelens.plans import price_gap as PG


def _summary(df):
    rows = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("max_rows", [0, 1_000_000])
@pytest.mark.parametrize("side", ["buy", "sell"])
def test_equal_legs_meet_a_price_once(spark, side, max_rows):
    same = [trade(f"2024-01-05 10:0{i}:00", units_sold=i + 0.5, units_bought=None if i == 1 else i + 1.0) for i in range(4)]
    t, p = frames(spark, same + [trade("2024-01-05 10:30:00", sell_price=None, buy_price=None)],
                  [price("2024-01-05 10:30:00", c, v) for c in ("ethereum", "usd-coin") for v in (3.0, 3.0, 5.0)])
    legs = LG.side_legs(t, side)
    pairs = LG.weighted_pairs(LG.counted_legs(legs), p, broadcast_max_rows=max_rows)
    # Two prices of legs, of which one is missing, by two distinct market prices.
    assert pairs.count() == 4 and pairs.agg(F.sum(F.col("m") * F.col("n"))).first()[0] == 15
    assert _summary(PG.leg_summary(pairs, weight="n", legs="m")) == _summary(PG.leg_summary(LG.leg_price_pairs(legs, p)))


@pytest.mark.parametrize("name", ["buy_legs", "sell_legs"])
def test_the_queries_count_their_legs_before_the_join(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert "Aggregate [slot" in plan.split("Join Inner")[1].split("ResolvedHint")[0] and ", trade_price#" in plan.split("Join Inner")[1]
