"""The load ledger and backfills that go on where they stopped."""

import datetime as dt

import pytest
from helpers import frames, price, trade
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradelens import jobs as JB
from tradelens.functions.identity import with_row_id
from tradelens.plans.price_gap import price_gap_daily
from tradelens.session import scratch_path
from tradelens.sinks import ledger as LG
from tradelens.sinks import load as LD

D = dt.date


def days(*numbers):
    return {D(2024, 1, n) for n in numbers}


def test_open_windows():
    got = LG.open_windows(D(2024, 1, 1), D(2024, 1, 9), days(3, 7), 3)
    assert [(a.day, b.day) for a, b in got] == [(1, 2), (4, 6), (8, 9)]
    assert [(a.day, b.day) for a, b in LG.open_windows(D(2024, 1, 1), D(2024, 1, 5), set(), 2)] == [(1, 2), (3, 4), (5, 5)]
    assert LG.open_windows(D(2024, 1, 1), D(2024, 1, 2), days(1, 2), 1) == []
    assert LG.open_windows(D(2024, 1, 2), D(2024, 1, 1), set(), 1) == []      # as_of on the first day
    with pytest.raises(ValueError):
        LG.open_windows(D(2024, 1, 1), D(2024, 1, 2), set(), 0)


def sources(spark):
    hours = [f"2024-01-{d:02d} {h}:00:00" for d in range(1, 7) for h in ("09", "15")]
    t, p = frames(spark, [trade(h, tx_hash=h) for h in hours] + [trade(hours[0], tx_hash=hours[0])],
                  [price(h, c, v) for h in hours for c, v in (("ethereum", 2.5), ("usd-coin", 1.5))])
    return t, p


def staging(spark, tag):
    base = scratch_path(spark, tag)
    return (JB.trades_table(spark, path=f"{base}/t"), JB.prices_table(spark, path=f"{base}/p"),
            LG.ledger_table(spark, path=f"{base}/ledger"), (f"{base}/summary", f"{base}/gap"))


def ledger_rows(ledger, job):
    return [tuple(r) for r in LG.progress(ledger, job).orderBy("first_day").collect()]


@pytest.mark.parametrize("dead", ["prices", "trades", "refresh", "ledger"])
def test_a_window_that_dies_is_finished_by_the_next_run(spark, monkeypatch, dead):
    """Killed while it reads prices, while it reads trades, before the refresh, before the entry."""
    t, p = sources(spark)
    trades, prices, ledger, results = staging(spark, f"dies-{dead}")
    gone = F.raise_error(F.lit("gone"))
    bad_p = p.withColumn("market_cap", F.when(F.col("date_time").startswith("2024-01-03"), gone.cast("double")).otherwise(F.col("market_cap")))
    bad_t = t.withColumn("tx_hash", F.when(F.dayofmonth("block_time") == 3, gone.cast("string")).otherwise(F.col("tx_hash")))
    calls = []
    real = {"refresh": JB.refresh_daily_results, "ledger": JB.write_entry}.get(dead)

    def dying(*args, **options):
        calls.append(args)
        if len(calls) == (2 if dead == "refresh" else 4):      # the ledger: started, done, started, done
            raise OSError("killed")
        return real(*args, **options)

    with monkeypatch.context() as m:
        if real is not None:
            m.setattr(JB, "refresh_daily_results" if dead == "refresh" else "write_entry", dying)
        with pytest.raises((PySparkException, OSError)):
            JB.resumable_backfill(spark, bad_t if dead == "trades" else t, bad_p if dead == "prices" else p,
                                  trades, prices, ledger, "2024-01-07", window_days=2, results=results)
    job = JB.job_name()
    assert LG.loaded_days(ledger, job) == days(1, 2)
    assert [r[2:4] for r in ledger_rows(ledger, job)] == [(1, "done"), (1, "started")]

    reports = JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-01-07", window_days=2, results=results)
    assert len(reports) == 4                                    # two windows of two tables
    rows = ledger_rows(ledger, job)
    assert [r[:4] for r in rows] == [(D(2024, 1, 1), D(2024, 1, 2), 1, "done"), (D(2024, 1, 3), D(2024, 1, 4), 2, "done"),
                                     (D(2024, 1, 5), D(2024, 1, 6), 1, "done")]
    # The first day's repeated trade is one row; what the dead attempt stored is not new again.
    stored_p, stored_t = (0 if dead != "prices" else 8), (4 if dead in ("prices", "trades") else 0)
    assert [r[4:] for r in rows] == [(5, 4, 8, 8), (4, stored_t, 8, stored_p), (4, 4, 8, 8)]
    assert trades.read().count() == 12 and prices.read().count() == 24
    want = price_gap_daily(trades.read(), prices.read())
    got = {tuple(r) for r in JB.read_daily_results(spark, *results)[1].select(*want.columns).collect()}
    assert got == {tuple(r) for r in want.collect()} and len(got) == 12


def test_a_later_run_loads_the_new_days_only(spark):
    t, p = sources(spark)
    trades, prices, ledger, _ = staging(spark, "later")
    JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-01-04", window_days=7)
    reports = JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-01-07", window_days=7)
    assert [(r.total_rows, r.inserted_rows) for r in reports] == [(12, 12), (6, 6)]
    assert JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-01-07", window_days=7) == []
    # Another set of coins is another job, with a ledger of its own.
    more = JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-01-07", window_days=7, coins=["ethereum"])
    assert [r.inserted_rows for r in more] == [0, 0]
    assert {r.job for r in ledger.read().select("job").distinct().collect()} == {JB.job_name(), JB.job_name(["ethereum"])}


def test_an_empty_source_and_a_first_of_the_month(spark):
    t, p = sources(spark)
    trades, prices, ledger, _ = staging(spark, "empty")
    JB.resumable_backfill(spark, t.limit(0), p.limit(0), trades, prices, ledger, "2024-01-03", window_days=1)
    assert [r[4:] for r in ledger_rows(ledger, JB.job_name())] == [(0, 0, 0, 0)] * 2
    assert JB.resumable_backfill(spark, t, p, trades, prices, ledger, "2024-02-01", start="2024-02-01") == []
    assert trades.read().count() == 0 == prices.read().count()


def test_ids_bucketed_by_id_are_read_without_an_exchange(spark):
    """Beyond the broadcast size only the batch is shuffled against the stored ids."""
    raw = spark.range(200).select(F.col("id").alias("n"), (F.col("id") * 3).alias("m"))
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_ids")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        table = LD.StagingTable(spark, name="bucket_ids.t", bucket_by=("id", 16))
        LD.load_frame(spark, raw.where("n < 150"), table)
        assert (LD.load_frame(spark, raw, table).inserted_rows, table.read().count()) == (50, 200)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = with_row_id(raw.withColumn("k", F.col("n") % 5))
        plan = LD.insert_new_rows(rows, LD._existing_ids(table, [], None))._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        join = plan[plan.index("SortMergeJoin"):]
        assert join.count("Exchange") == 1 and "FileScan parquet" in join and "Bucketed: true" in join, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP DATABASE bucket_ids CASCADE")
