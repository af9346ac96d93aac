"""Load windows of the trade and price scans (SC2, SC3, SC5, SC6)."""

import datetime as dt

from helpers import frames, price, trade
from tradelens.sources import prices as PR
from tradelens.sources import trades as TR


def _trades(spark):
    t, _ = frames(spark, [trade("2024-01-31 23:00:00", tx_hash="jan"), trade("2024-02-01 00:10:00", tx_hash="f1"),
                          trade("2024-02-14 12:00:00", tx_hash="f14"), trade("2024-02-15 01:00:00", tx_hash="f15"),
                          trade("2024-02-14 13:00:00", tx_hash="other", buy_token="DAI")], [])
    return t


def test_month_to_date_window(spark):
    got = sorted(r.tx_hash for r in TR.trades_month_to_date(_trades(spark), dt.date(2024, 2, 15)).collect())
    assert got == ["f1", "f14"]          # from the 1st, before as_of, one direction only


def test_first_of_month_window_is_empty(spark):
    assert TR.trades_month_to_date(_trades(spark), "2024-02-01").count() == 0


def test_previous_day_window(spark):
    got = [r.tx_hash for r in TR.trades_prev_day(_trades(spark), "2024-02-15").collect()]
    assert got == ["f14"]
    both = TR.trade_window(_trades(spark), "DAI", "USDC", lo=dt.date(2024, 2, 1), hi_exclusive=dt.date(2024, 2, 15))
    assert [r.tx_hash for r in both.collect()] == ["other"]


def test_price_windows(spark):
    _, p = frames(spark, [], [price("2024-02-01 00:00:00"), price("2024-02-14 23:59:59"), price("2024-02-15 00:00:00"),
                              price("2024-02-10 10:00:00", "usd-coin")])
    init = sorted(r.date_time for r in PR.init_price_window(p, "ethereum", "2024-02-15").collect())
    assert init == ["2024-02-01 00:00:00", "2024-02-14 23:59:59"]
    start = sorted(r.date_time for r in PR.init_price_window(p, "ethereum", "2024-02-15", start="2024-02-10").collect())
    assert start == ["2024-02-14 23:59:59"]
    day = [r.date_time for r in PR.update_price_window(p, "ethereum", "2024-02-14").collect()]
    assert day == ["2024-02-14 23:59:59"]


def test_price_windows_of_two_loads_from_one_scan(spark):
    from helpers import frames, price
    from tradelens.session import scratch_path
    from tradelens.sources import prices as PR
    times = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-13 10:00:00", "2024-01-14 00:00:00", "2024-01-14 23:59:59",
             "2024-01-15 00:00:00"]
    _, p = frames(spark, [], [price(t, c) for t in times for c in ("ethereum", "usd-coin", "other")])
    path = scratch_path(spark, "windows")
    p.write.parquet(path)
    p = spark.read.schema(p.schema).parquet(path)
    got = PR.price_windows(p, ["ethereum", "usd-coin"], "2024-01-15", "2024-01-14")
    want = [(r.date_time, r.coin, load) for c in ("ethereum", "usd-coin") for load, df in (
        ("init", PR.init_price_window(p, c, "2024-01-15")), ("update", PR.update_price_window(p, c, "2024-01-14"))) for r in df.collect()]
    assert sorted((r.date_time, r.coin, r.load) for r in got.collect()) == sorted(want) and len(want) == 12
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1  # noqa: SLF001
