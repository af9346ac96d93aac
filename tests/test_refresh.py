"""Replacing days of the materialized results, and the incremental results."""

import datetime as dt

import pytest
from helpers import frames, price, trade
from pyspark.sql import functions as F

from tradelens import jobs as JB
from tradelens.functions.identity import with_row_id
from tradelens.session import scratch_path
from tradelens.sinks import load as LD

D = dt.date


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_days_are_ranges_that_reach_the_scan(spark):
    t, p = frames(spark, [trade(f"2024-01-{d:02d} 23:59:59", tx_hash=str(d)) for d in range(1, 29)],
                  [price(f"2024-01-{d:02d} 00:00:00") for d in range(1, 29)])
    base = scratch_path(spark, "ranges")
    t.write.parquet(f"{base}/t")
    p.write.parquet(f"{base}/p")
    days = [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 9)]
    for df, col, text in ((spark.read.parquet(f"{base}/t"), "block_time", False), (spark.read.parquet(f"{base}/p"), "date_time", True)):
        got = df.where(JB.in_days(col, days, text))
        assert sorted(r[0] for r in got.select(F.dayofmonth(F.col(col).cast("timestamp_ntz"))).collect()) == [3, 4, 9]
        assert f"PushedFilters: [Or(And(GreaterThanOrEqual({col},2024-01-03" in _plan(got)
        assert df.where(JB.in_days(col, [], text)).count() == 0
        many = [D(2024, 1, 1) + dt.timedelta(days=2 * i) for i in range(90)]
        assert df.where(JB.in_days(col, many, text)).count() == 14


def test_null_days_equal_the_recomputation(spark):
    from tradelens.operators.aggregates import daily_trade_summary
    t, _ = frames(spark, [trade("2024-01-03 10:00:00", tx_hash="a"), trade("2024-01-03 11:00:00", tx_hash="b"),
                          trade("2024-01-04 10:00:00", tx_hash="c")], [])
    t = t.withColumn("block_date", F.when(F.col("tx_hash") != "a", F.col("block_date")))
    base = scratch_path(spark, "null-day")
    trades, prices = JB.trades_table(spark, path=f"{base}/t"), JB.prices_table(spark, path=f"{base}/p")
    prices.ensure()
    results = (f"{base}/summary", f"{base}/gap")
    for _ in range(2):
        reports = JB.load_and_refresh(spark, trades, prices, results, lambda: [
            LD.insert_if_absent(spark, with_row_id(t), trades, day_columns=(F.to_date("block_time"), F.col("block_date")))])
        assert reports[0].days == [None, D(2024, 1, 3), D(2024, 1, 4)]
        assert _rows(JB.read_daily_results(spark, *results)[0]) == _rows(daily_trade_summary(t))
    # The null day goes when its rows go.
    JB.refresh_daily_results(spark, t.where("block_date is not null"), prices.read(), [None], *results)
    assert [r.block_date for r in JB.read_daily_results(spark, *results)[0].orderBy("block_date").collect()] == [
        D(2024, 1, 3), D(2024, 1, 4)]


@pytest.mark.parametrize("at", ["compute", "remove"])
def test_readers_see_old_or_new_days(spark, monkeypatch, at):
    """A refresh that dies while it computes leaves the old days; one that dies after the swap
    leaves the new ones, and the next run of the same days finishes it."""
    t, p = frames(spark, [trade(f"2024-01-0{d} 10:00:00", buy_price=3.0, tx_hash=str(d)) for d in (3, 4, 5)],
                  [price(f"2024-01-0{d} 10:30:00") for d in (3, 4, 5)])
    results = (scratch_path(spark, "s"), scratch_path(spark, "g"))
    days = [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)]
    JB.refresh_daily_results(spark, t, p, days, *results)
    old = [_rows(df) for df in JB.read_daily_results(spark, *results)]
    assert [len(rows) for rows in old] == [3, 3]
    changed = t.where("tx_hash <> '5'").withColumn("usd_value", F.lit(7.0))
    if at == "compute":
        broken = changed.withColumn("sell_price", F.when(F.col("tx_hash") == "4", F.raise_error(F.lit("lost")).cast("double"))
                                    .otherwise(F.col("sell_price")))
    else:
        broken = changed
        monkeypatch.setattr(JB, "remove_path", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        JB.refresh_daily_results(spark, broken, p, days, *results)
    summary, gap = (_rows(df) for df in JB.read_daily_results(spark, *results))
    assert gap == old[1]
    if at == "compute":
        assert summary == old[0]
    else:
        # New rows for the days that have some, the old ones of the emptied day until it goes.
        assert sorted(r[2] for r in summary) == days and summary != old[0]
    monkeypatch.undo()
    JB.refresh_daily_results(spark, changed, p, days, *results)
    summary, gap = (_rows(df) for df in JB.read_daily_results(spark, *results))
    assert len(summary) == 2 and len(gap) == 2


def test_loads_and_refreshes_leave_no_scratch_folder(spark):
    import glob
    from tradelens.session import ensure_checkpoint_dir
    t, p = frames(spark, [trade("2024-01-03 10:00:00")], [price("2024-01-03 10:30:00")])
    base = scratch_path(spark, "tidy")
    trades, prices = JB.trades_table(spark, path=f"{base}/t"), JB.prices_table(spark, path=f"{base}/p")
    root = ensure_checkpoint_dir(spark)
    before = set(glob.glob(f"{root}/*"))
    JB.load_and_refresh(spark, trades, prices, (f"{base}/s", f"{base}/g"), lambda: [
        LD.insert_if_absent(spark, with_row_id(t), trades, day_columns=(F.to_date("block_time"),)),
        LD.insert_if_absent(spark, with_row_id(p), prices)])
    assert set(glob.glob(f"{root}/*")) - before == {base}


# --------------------------------------------------------------------------- incremental results

def _results(spark, name="inc"):
    from tradelens.plans.incremental import IncrementalResults
    base = scratch_path(spark, name)
    return IncrementalResults(spark, f"{base}/states", JB.trades_table(spark, path=f"{base}/t"),
                              JB.prices_table(spark, path=f"{base}/p"))


def _same(results, t, p):
    from tradelens.operators.aggregates import daily_trade_summary
    from tradelens.plans.price_gap import price_gap_daily
    assert _rows(results.summary()) == _rows(daily_trade_summary(t.distinct()))
    got = {(r.date, r.token): r.avg_price_difference for r in results.price_gap().collect()}
    want = {(r.date, r.token): r.avg_price_difference for r in price_gap_daily(t.distinct(), p.distinct()).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def _history(spark):
    rows = [trade(f"2024-01-0{d} {h:02d}:15:00", buy_price=float(h + d), sell_price=1.0 + d / 4, tx_hash=f"h{h % 3}",
                  token_pair=None if h == 4 else "USDC-WETH") for d in (3, 4, 5) for h in (1, 4, 13, 16)]
    rows += [trade("2024-01-04 13:15:00", buy_price=None, tx_hash=None), rows[0]]
    quotes = [price(f"2024-01-0{d} {h:02d}:30:00", coin, float(d + h)) for d in (3, 4, 5) for h in (1, 4, 13)
              for coin in ("ethereum", "usd-coin", "other")]
    t, p = frames(spark, rows, quotes)
    undated = F.when((F.col("tx_hash") != "h1") | F.col("tx_hash").isNull(), F.col("block_date"))
    return t.withColumn("block_date", undated), p


def test_late_trades_and_prices_update_both_results(spark):
    t, p = _history(spark)
    ids, quotes = with_row_id(t), with_row_id(p)
    results = _results(spark)
    early, first = F.hour("block_time") < 10, F.substring("date_time", 12, 2) < "04"
    reports = results.load(ids.where(early), quotes.where(first))
    assert [(r.total_rows, r.inserted_rows) for r in reports] == [(7, 6), (9, 9)]
    _same(results, t.where(early), p.where(first))
    results.load(None, quotes)                       # late prices meet the stored legs
    _same(results, t.where(early), p)
    reports = results.load(ids)                      # late trades meet the stored quotes
    assert reports[0].total_rows == 14 and reports[0].inserted_rows == 7
    _same(results, t, p)
    results.load(ids, quotes)
    results.load(ids.limit(0), None)
    _same(results, t, p)
    assert results.trades.read().count() == 13 and results.recover() == []


def test_a_delta_reads_the_touched_days_states_and_no_trade(spark):
    t, p = _history(spark)
    results = _results(spark, "inc-plan")
    results.load(with_row_id(t), with_row_id(p))
    days = [D(2024, 1, 4)]
    late, _ = frames(spark, [trade("2024-01-04 01:20:00", buy_price=9.0, tx_hash="new")], [])
    delta = results.gap_delta(results.legs_of(late), results.quotes_of(p.limit(0)), results.state("legs", [], "b"),
                              results.state("quotes", days, "b"))
    sums = results.hash_sums(late, results.state("hashes", days, "b"))
    for plan in (_plan(delta), _plan(sums)):
        assert any("day#" in scan.split("PushedFilters")[0] for scan in plan.split("PartitionFilters: ")[1:])
    files = {f for df in (delta, sums) for f in df.inputFiles()}
    assert files and not any("/t/" in f for f in files)
    assert {r.day for r in results.state("quotes", days, "b").select("day").distinct().collect()} == set(days)


@pytest.mark.parametrize("step", ["keep", "insert", "gap"])
def test_a_load_that_died_is_finished_or_dropped(spark, monkeypatch, step):
    from tradelens.plans import incremental as IN
    t, p = _history(spark)
    early = F.hour("block_time") < 10
    results = _results(spark, f"inc-{step}")
    results.load(with_row_id(t.where(early)), with_row_id(p))
    lost = RuntimeError("lost")

    def fail(*args, **kwargs):
        raise lost

    with monkeypatch.context() as m:
        write = results._write
        if step == "keep":
            m.setattr(IN, "new_rows", fail)
        elif step == "insert":
            m.setattr(IN, "insert_if_absent", fail)
        else:
            m.setattr(results, "_write", lambda name, *a: fail() if name == step else write(name, *a))
        with pytest.raises(RuntimeError, match="lost"):
            results.load(with_row_id(t))
    assert len(results.recover()) == (step != "keep")
    _same(results, t.where(early) if step == "keep" else t, p)
    results.load(with_row_id(t), with_row_id(p))
    _same(results, t, p)
