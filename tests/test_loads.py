"""Idempotent loads, catalog objects, jobs and the streaming load."""

import datetime as dt
import re
import uuid

import pytest

from pyspark.sql import functions as F

from helpers import frames, price, trade
from tradelens import jobs as JB
from tradelens.functions.identity import with_row_id
from tradelens.session import scratch_path
from tradelens.sinks import load as LD
from tradelens.sinks import tables as TB
from tradelens.sinks import views as VW
from tradelens.sources import prices as PR
from tradelens.streaming import price_stream as ST


def _rows(spark):
    t, _ = frames(spark, [trade("2024-01-14 10:00:00", tx_hash="a"), trade("2024-01-14 10:00:00", tx_hash="a"),
                          trade("2024-01-14 11:00:00", tx_hash="b"), trade("2024-01-13 11:00:00", tx_hash="c")], [])
    return with_row_id(t)


def test_load_twice_equals_once_and_counts(spark):
    table = JB.trades_table(spark, path=scratch_path(spark, "t-load"))
    r1 = LD.insert_if_absent(spark, _rows(spark), table)
    r2 = LD.insert_if_absent(spark, _rows(spark), table)
    assert (r1.total_rows, r1.inserted_rows) == (4, 3)     # identical rows collapse
    assert (r2.total_rows, r2.inserted_rows) == (4, 0)
    assert table.read().count() == 3


def test_changed_value_is_a_new_row(spark):
    table = JB.trades_table(spark, path=scratch_path(spark, "t-change"))
    t1, _ = frames(spark, [trade("2024-01-14 10:00:00", buy_price=2.0)], [])
    t2, _ = frames(spark, [trade("2024-01-14 10:00:00", buy_price=2.5)], [])
    LD.insert_if_absent(spark, with_row_id(t1), table)
    LD.insert_if_absent(spark, with_row_id(t2), table)
    assert table.read().count() == 2


def test_batch_order_does_not_matter(spark):
    rows = _rows(spark)
    a, b = rows.where(F.col("tx_hash") == "a"), rows.where(F.col("tx_hash") != "a")
    t1 = JB.trades_table(spark, path=scratch_path(spark, "t-order1"))
    t2 = JB.trades_table(spark, path=scratch_path(spark, "t-order2"))
    for batch in (a, b, a):
        LD.insert_if_absent(spark, batch, t1)
    for batch in (b, a):
        LD.insert_if_absent(spark, batch, t2)
    assert sorted(r.id for r in t1.read().collect()) == sorted(r.id for r in t2.read().collect())


def test_empty_batch_writes_nothing(spark):
    table = JB.trades_table(spark, path=scratch_path(spark, "t-empty"))
    report = LD.insert_if_absent(spark, _rows(spark).limit(0), table)
    assert (report.total_rows, report.inserted_rows) == (0, 0)
    assert not table.exists()


def test_seed_if_empty(spark):
    rows = _rows(spark)
    assert LD.seed_if_empty(rows.limit(0), rows.limit(1)).count() == 1
    assert LD.seed_if_empty(rows, rows.limit(1)).count() == 4


def test_catalog_tables_views_and_backfill(spark):
    tag = uuid.uuid4().hex[:6]
    staging = TB.create_namespace(spark, f" Staging {tag} ")
    dw = TB.create_namespace(spark, f"Data Warehouse {tag}")
    assert staging == f"staging_{tag}" and spark.catalog.databaseExists(dw)
    t, p = frames(spark, [trade("2024-01-03 10:00:00"), trade("2024-01-14 10:00:00"), trade("2024-01-15 10:00:00")],
                  [price("2024-01-03 10:30:00", "ethereum", 1.0), price("2024-01-14 10:30:00", "usd-coin", 1.0),
                   price("2024-01-15 10:30:00", "ethereum", 1.0)])
    trades = JB.trades_table(spark, name=f"{staging}.trades")
    prices = JB.prices_table(spark, name=f"{staging}.coin_prices")
    JB.backfill(spark, t, p, trades, prices, dt.date(2024, 1, 15), views_db=dw)
    assert spark.catalog.tableExists(f"{staging}.trades")
    assert trades.read().count() == 2 and prices.read().count() == 2
    # The daily load of the 15th adds nothing new (the 14th is already in); of the 16th, the 15th.
    JB.daily_load(spark, t, p, trades, prices, dt.date(2024, 1, 15))
    assert trades.read().count() == 2
    JB.daily_load(spark, t, p, trades, prices, dt.date(2024, 1, 16))
    assert trades.read().count() == 3 and prices.read().count() == 3
    views = {r.name for r in spark.catalog.listTables(dw)}
    assert {"price_gap_daily", "trade_summary_daily"} <= views
    assert spark.table(f"{dw}.trade_summary_daily").count() == 3
    TB.drop_tables(spark, [f"{staging}.trades", f"{staging}.coin_prices"])
    assert not spark.catalog.tableExists(f"{staging}.trades")


def test_view_sql_equals_dataframe_form(spark):
    from tradelens.plans import price_gap as PG
    t, p = frames(spark, [trade("2024-01-05 03:10:00", buy_price=3.0), trade("2024-01-05 15:10:00", sell_token="WETH", buy_token="USDC"),
                          trade("2024-01-05 15:11:00", buy_price=None)],
                  [price("2024-01-05 03:20:00", "ethereum", 1.0), price("2024-01-05 15:20:00", "usd-coin", 2.0),
                   price("2024-01-05 15:25:00", "ethereum", 2.0), ("2024-01-05 15:26:00", None, None, None, "usd-coin")])
    t.createOrReplaceTempView("vt_trades")
    p.createOrReplaceTempView("vt_prices")
    for mode in ("12h", "24h"):
        sql = spark.sql(VW.price_gap_view_sql("vt_trades", "vt_prices", mode))
        got = sorted((r.date, r.token, round(r.avg_price_difference, 9)) for r in sql.collect())
        want = sorted((r.date, r.token, round(r.avg_price_difference, 9))
                      for r in PG.price_gap_daily(t, p, mode).collect())
        assert got == want


def test_stream_replay_adds_nothing(spark):
    base = scratch_path(spark, "stream")
    docs = spark.createDataFrame([
        ("ethereum", '{"prices": [[1704067200000, 2.0], [1704070800000, 2.5]], "market_caps": [[1704067200000, 3.0], '
                     '[1704070800000, 3.5]], "total_volumes": [[1704067200000, 4.0], [1704070800000, 4.5]]}'),
        ("usd-coin", '{"prices": [[1704067200000, 1.0]], "market_caps": [[1704067200000, 1.0]], '
                     '"total_volumes": [[1704067200000, 1.0]]}'),
        ("usd-coin", '{"error": "rate limited"}')], "coin string, doc string")
    ST.land_price_docs(docs, f"{base}/landing")
    table = JB.prices_table(spark, path=f"{base}/table")
    ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck1").awaitTermination()
    assert table.read().count() == 3
    # An overlapping document lands later: only its new hour is added.
    more = spark.createDataFrame([("ethereum", '{"prices": [[1704070800000, 2.5], [1704074400000, 2.7]], '
                                               '"market_caps": [[1704070800000, 3.5], [1704074400000, 3.7]], '
                                               '"total_volumes": [[1704070800000, 4.5], [1704074400000, 4.7]]}')],
                                 "coin string, doc string")
    ST.land_price_docs(more, f"{base}/landing")
    ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck1").awaitTermination()
    assert table.read().count() == 4
    ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck2").awaitTermination()
    assert table.read().count() == 4
    landed = PR.read_price_docs(spark, f"{base}/landing")
    assert landed.count() == 5 and set(r.coin for r in landed.collect()) == {"ethereum", "usd-coin"}


def test_read_one_pretty_printed_document_per_file(spark):
    import json
    import os
    base = scratch_path(spark, "docs-multiline")
    doc = {"prices": [[1728691391999, 2400.5], [1728694991000, 2401.0]],
           "market_caps": [[1728691391999, 1.0e11], [1728694991000, 1.1e11]],
           "total_volumes": [[1728691391999, 5.0e9], [1728694991000, 5.5e9]]}
    for coin, body in (("ethereum", doc), ("usd-coin", {"error": "not found"})):
        os.makedirs(f"{base}/coin={coin}", exist_ok=True)
        with open(f"{base}/coin={coin}/2024-10-12.json", "w") as fh:
            json.dump(body, fh, indent=2)
    rows = sorted((r.coin, r.date_time, r.prices) for r in PR.read_price_docs(spark, base, multi_line=True).collect())
    assert rows == [("ethereum", "2024-10-12 00:03:11", 2400.5), ("ethereum", "2024-10-12 01:03:11", 2401.0)]


def test_daily_scan_prunes_trade_partitions(spark):
    from tradelens.sources import trades as TR
    table = JB.trades_table(spark, path=scratch_path(spark, "t-prune"))
    LD.insert_if_absent(spark, _rows(spark), table)
    scan = TR.trades_prev_day(table.read(), dt.date(2024, 1, 15))
    plan = scan._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "PartitionFilters: [isnotnull(block_date" in plan and "2024-01-14" in plan
    assert scan.count() == 2      # the two identical rows of the 14th were stored once


def test_bucketed_trades_summary_needs_no_history_shuffle(spark):
    from tradelens.operators import aggregates as AG
    tag = uuid.uuid4().hex[:6]
    db = TB.create_namespace(spark, f"bucketed_{tag}")
    table = JB.trades_table(spark, name=f"{db}.trades", buckets=4)
    LD.insert_if_absent(spark, _rows(spark), table)
    LD.insert_if_absent(spark, _rows(spark), table)
    summary = AG.daily_trade_summary(table.read())
    plan = summary._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1     # only the final (day, pair) merge
    got = {r.block_date.isoformat(): r.no_txn for r in summary.collect()}
    assert got == {"2024-01-13": 1, "2024-01-14": 2}


def test_stream_into_a_catalog_table_sees_its_own_appends(spark):
    """foreachBatch runs in a cloned session: the target is refreshed before each anti-join."""
    tag = uuid.uuid4().hex[:6]
    db = TB.create_namespace(spark, f"stream_{tag}")
    base = scratch_path(spark, "stream-catalog")
    table = JB.prices_table(spark, name=f"{db}.coin_prices")
    doc = ('{"prices": [[1704067200000, 2.0], [1704070800000, 2.5]], "market_caps": [[1704067200000, 3.0], '
           '[1704070800000, 3.5]], "total_volumes": [[1704067200000, 4.0], [1704070800000, 4.5]]}')
    for i in range(3):  # the same document lands three times, one file per trigger
        ST.land_price_docs(spark.createDataFrame([("ethereum", doc)], "coin string, doc string"), f"{base}/landing")
        ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck", max_files_per_trigger=1).awaitTermination()
        assert table.read().count() == 2
    ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck-replay",
                         max_files_per_trigger=1).awaitTermination()
    assert table.read().count() == 2


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_POOL = [trade(f"2024-01-{d:02d} {h:02d}:00:00", tx_hash=f"t{i}", buy_price=1.0 + i)
         for i, (d, h) in enumerate([(13, 1), (13, 2), (14, 1), (14, 1), (14, 3), (15, 4)])]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(st.lists(st.integers(0, len(_POOL) - 1), min_size=0, max_size=6), min_size=1, max_size=3))
def test_any_batch_sequence_stores_each_row_once(spark, batches):
    table = JB.trades_table(spark, path=scratch_path(spark, "t-prop"))
    inserted = 0
    for batch in batches:
        t, _ = frames(spark, [_POOL[i] for i in batch], [])
        inserted += LD.insert_if_absent(spark, with_row_id(t), table).inserted_rows
    distinct_rows = {_POOL[i][2] for b in batches for i in b}
    stored = table.read().collect() if table.exists() else []
    assert sorted(r.tx_hash for r in stored) == sorted(distinct_rows)
    assert inserted == len(distinct_rows)


def test_load_any_frame_infers_the_table(spark):
    tag = uuid.uuid4().hex[:6]
    db = TB.create_namespace(spark, f"generic_{tag}")
    raw = spark.createDataFrame([(0, " x ", 1, 2.5, True), (1, "y", None, 3.0, False), (1, "y", None, 3.0, False)],
                                "`Unnamed: 0` long, ` Pair Name ` string, `Units` int, `Price USD` double, `Partial Fill` boolean")
    table = TB.StagingTable(spark, name=f"{db}.generic")
    first = LD.load_frame(spark, raw, table)
    again = LD.load_frame(spark, raw, table)
    assert (first.total_rows, first.inserted_rows, again.inserted_rows) == (3, 2, 0)
    stored = spark.table(f"{db}.generic")
    assert [(f.name, f.dataType.simpleString()) for f in stored.schema.fields] == [
        ("id", "string"), ("column_0", "bigint"), ("pair_name", "string"), ("units", "bigint"),
        ("price_usd", "double"), ("partial_fill", "boolean")]


def test_read_documents_named_by_coin(spark):
    import json
    import os
    base = scratch_path(spark, "docs-by-name")
    os.makedirs(base, exist_ok=True)
    doc = {"prices": [[1728691391999, 2400.5]], "market_caps": [[1728691391999, 1.0]],
           "total_volumes": [[1728691391999, 2.0]]}
    for name in ("ethereum_2024-10-12.json", "usd-coin_2024-10-12.json"):
        with open(os.path.join(base, name), "w") as fh:
            json.dump(doc, fh, indent=2)
    rows = sorted((r.coin, r.date_time) for r in PR.read_price_docs(spark, base, multi_line=True,
                                                                        coin_from="file_name").collect())
    assert rows == [("ethereum", "2024-10-12 00:03:11"), ("usd-coin", "2024-10-12 00:03:11")]


def test_stream_archives_loaded_documents(spark):
    import glob
    import time
    base = scratch_path(spark, "stream-archive")
    doc = ('{"prices": [[1704067200000, 2.0]], "market_caps": [[1704067200000, 3.0]], '
           '"total_volumes": [[1704067200000, 4.0]]}')
    for _ in range(2):
        ST.land_price_docs(spark.createDataFrame([("ethereum", doc)], "coin string, doc string"), f"{base}/landing")
    table = JB.prices_table(spark, path=f"{base}/table")
    ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/ck", max_files_per_trigger=1,
                         archive_dir=f"{base}/archive").awaitTermination()
    assert table.read().count() == 1
    for _ in range(50):  # files are moved after each commit, possibly by a background thread
        if not glob.glob(f"{base}/landing/coin=ethereum/*.txt"):
            break
        time.sleep(0.2)
    assert glob.glob(f"{base}/archive/**/*.txt", recursive=True)


def test_both_directions_load_as_one_batch(spark):
    t, _ = frames(spark, [trade("2024-01-14 10:00:00", tx_hash="a"),
                          trade("2024-01-14 11:00:00", tx_hash="b", sell_token="WETH", buy_token="USDC"),
                          trade("2024-01-14 12:00:00", tx_hash="c", sell_token="DAI", buy_token="WETH"),
                          trade("2024-01-13 11:00:00", tx_hash="d")], [])
    table = JB.trades_table(spark, path=scratch_path(spark, "t-directions"))
    report = JB.load_trades(spark, t, table, dt.date(2024, 1, 15),
                            directions=[("WETH", "USDC"), ("USDC", "WETH")])
    assert report.inserted_rows == 2
    assert sorted(r.tx_hash for r in table.read().collect()) == ["a", "b"]
    monthly = JB.trades_table(spark, path=scratch_path(spark, "t-directions-mtd"))
    JB.load_trades(spark, t, monthly, dt.date(2024, 1, 15), initial=True,
                   directions=[("WETH", "USDC"), ("USDC", "WETH")])
    assert sorted(r.tx_hash for r in monthly.read().collect()) == ["a", "b", "d"]


def test_price_anti_join_reads_only_the_window(spark):
    _, p = frames(spark, [], [price("2024-01-13 10:00:00"), price("2024-01-14 10:00:00"), price("2024-01-14 11:00:00")])
    table = JB.prices_table(spark, path=scratch_path(spark, "p-window"))
    JB.load_prices(spark, p, table, ["ethereum"], dt.date(2024, 1, 15), initial=True)
    span = {"lo0": "ethereum", "hi0": "ethereum", "null0": 0,
            "lo1": "2024-01-14 00:00:00", "hi1": "2024-01-14 23:59:59", "null1": 0}
    stored = LD._existing_ids(table, ["coin", "date_time"], span)  # noqa: SLF001
    plan = stored._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert re.search(r"PartitionFilters: \[[^\]]*coin", plan) and "GreaterThanOrEqual(date_time,2024" in plan
    assert stored.count() == 2
    assert JB.load_prices(spark, p, table, ["ethereum"], dt.date(2024, 1, 15)).inserted_rows == 0


def test_refresh_daily_results_incrementally(spark):
    from pyspark.sql import functions as F
    from conftest import SF_SMALL
    from tradelens.operators import aggregates as AG
    from tradelens.plans import price_gap as PG
    from tradelens.sources import fixtures as FX
    trades, prices = FX.fixture_tables(spark, SF_SMALL)
    base = scratch_path(spark, "results")
    s_path, g_path = f"{base}/summary", f"{base}/gap"

    def rows(df, cols):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in cols))
                      for r in df.collect())
    early = [dt.date(2024, 1, d) for d in range(1, 15)]
    late = [dt.date(2024, 1, d) for d in range(15, 31)]
    # Day by day as the data arrives: first the early days from the early trades only ...
    JB.refresh_daily_results(spark, trades.where(F.col("block_date") < dt.date(2024, 1, 15)), prices, early,
                             s_path, g_path)
    # ... then the late days, and the 14th once more (a rerun replaces its partition).
    JB.refresh_daily_results(spark, trades, prices, late + [dt.date(2024, 1, 14)], s_path, g_path)
    summary, gap = JB.read_daily_results(spark, s_path, g_path)
    want_gap = PG.price_gap_daily(trades, prices)
    assert rows(gap, ["date", "token", "avg_price_difference"]) == \
        rows(want_gap, ["date", "token", "avg_price_difference"])
    cols = ["block_date", "token_pair", "no_txn", "total_usd_value_bought", "avg_sell_price"]
    assert rows(summary, cols) == rows(AG.daily_trade_summary(trades), cols)


def test_jobs_materialize_the_loaded_days(spark):
    t, p = frames(spark, [trade("2024-01-03 10:00:00", buy_price=3.0), trade("2024-01-15 10:00:00", buy_price=3.0)],
                  [price("2024-01-03 10:30:00", "ethereum", 1.0), price("2024-01-15 10:30:00", "ethereum", 1.0)])
    base = scratch_path(spark, "jobs-results")
    trades = JB.trades_table(spark, path=f"{base}/trades")
    prices = JB.prices_table(spark, path=f"{base}/prices")
    results = (f"{base}/summary", f"{base}/gap")
    JB.backfill(spark, t, p, trades, prices, dt.date(2024, 1, 15), results=results)
    JB.daily_load(spark, t, p, trades, prices, dt.date(2024, 1, 16), results=results)
    summary, gap = JB.read_daily_results(spark, *results)
    assert sorted((r.date, r.token, r.avg_price_difference) for r in gap.collect()) == \
        [("2024-01-03", "WETH", 25.0), ("2024-01-15", "WETH", 25.0)]
    assert sorted(r.block_date.isoformat() for r in summary.collect()) == ["2024-01-03", "2024-01-15"]


@pytest.mark.parametrize("coin,time", [(None, "2024-01-14 10:00:00"), ("", "2024-01-14 10:00:00"), ("ethereum", None), (None, None)])
def test_replay_with_null_or_empty_values_adds_nothing(spark, coin, time):
    p = spark.createDataFrame([(time, 1.0, None, 2.0, coin), ("2024-01-14 11:00:00", 1.5, None, 2.0, coin)],
                              "date_time string, prices double, market_cap double, total_volume double, coin string")
    for table in (JB.prices_table(spark, path=scratch_path(spark, "p-odd")),
                  JB.prices_table(spark, name=f"{TB.create_namespace(spark, 'odd_' + uuid.uuid4().hex[:6])}.coin_prices")):
        counts = [LD.insert_if_absent(spark, with_row_id(p), table, range_columns=("date_time",)).inserted_rows for _ in range(3)]
        assert counts == [2, 0, 0]
        assert table.read().count() == 2
        assert {r.coin for r in table.read().collect()} == {coin}


def test_null_block_date_replayed_with_many_partitions(spark):
    t, _ = frames(spark, [trade("2024-01-14 10:00:00", tx_hash=f"a{i}") for i in range(3)], [])
    t = t.withColumn("block_date", F.when(F.col("tx_hash") != "a0", F.col("block_date")))
    table = JB.trades_table(spark, path=scratch_path(spark, "t-null-date"))
    assert [LD.insert_if_absent(spark, with_row_id(t), table).inserted_rows for _ in range(3)] == [3, 0, 0]


def test_ten_coins_load_from_one_scan(spark):
    base = scratch_path(spark, "ten-coins")
    _, p = frames(spark, [], [price("2024-01-14 10:00:00", f"c{i}") for i in range(10)])
    p.write.parquet(base)
    source = spark.read.schema(p.schema).parquet(base)
    scan = PR.price_window(source, [f"c{i}" for i in range(10)], "2024-01-14 00:00:00", "2024-01-14 23:59:59")
    assert scan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1  # noqa: SLF001
    table = JB.prices_table(spark, path=scratch_path(spark, "ten-coins-table"))
    assert JB.load_prices(spark, source, table, [f"c{i}" for i in range(10)], dt.date(2024, 1, 15)).inserted_rows == 10


def test_files_follow_the_bytes_not_the_tasks(spark):
    import glob
    rows = spark.range(2000).repartition(40).select(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 30 + 1).cast("string"), 2, "0"), F.lit(" 10:00:00")).alias("date_time"),
        F.col("id").cast("double").alias("prices"), F.lit(1.0).alias("market_cap"), F.lit(1.0).alias("total_volume"),
        F.concat(F.lit("c"), F.col("id") % 20).alias("coin"))
    table = JB.prices_table(spark, path=scratch_path(spark, "files"))
    LD.insert_if_absent(spark, with_row_id(rows), table)
    assert len(glob.glob(f"{table.path}/coin=*/*.parquet")) <= 20 + 2


def test_late_prices_drifted_dates_and_emptied_days(spark):
    from tradelens.plans import price_gap as PG
    t, p = frames(spark, [trade("2024-01-10 10:00:00", buy_price=3.0, tx_hash="a"), trade("2024-01-14 10:00:00", buy_price=3.0, tx_hash="b")],
                  [price("2024-01-10 10:30:00", "ethereum", 1.0), price("2024-01-14 10:30:00", "ethereum", 1.0),
                   price("2024-01-10 22:30:00", "ethereum", 5.0)])
    t = t.withColumn("block_date", F.date_add("block_date", 4))   # four days off its block_time
    base = scratch_path(spark, "late")
    trades, prices = JB.trades_table(spark, path=f"{base}/trades"), JB.prices_table(spark, path=f"{base}/prices")
    results = (f"{base}/summary", f"{base}/gap")

    def load(part):
        def run():
            days = (F.to_date("block_time"), F.col("block_date"))
            time = F.to_date(F.col("date_time").cast("timestamp_ntz"))
            return [LD.insert_if_absent(spark, with_row_id(t), trades, day_columns=days),
                    LD.insert_if_absent(spark, with_row_id(part), prices, day_columns=(time,))]
        JB.load_and_refresh(spark, trades, prices, results, run)
        return sorted((r.date, r.token, r.avg_price_difference) for r in JB.read_daily_results(spark, *results)[1].collect())

    assert load(p.where("prices = 1.0")) == [("2024-01-10", "WETH", 25.0), ("2024-01-14", "WETH", 25.0)]
    want = sorted((r.date, r.token, r.avg_price_difference) for r in PG.price_gap_daily(t, p).collect())
    assert load(p.where("prices = 5.0")) == want and ("2024-01-10", "WETH", 6.25) in want
    # A day that has no rows any more is replaced by nothing.
    JB.refresh_daily_results(spark, t.where("tx_hash = 'b'"), p, ["2024-01-10", "2024-01-14"], *results)
    assert [r.date for r in JB.read_daily_results(spark, *results)[1].collect()] == ["2024-01-14"]


def test_views_need_catalog_tables(spark):
    t, p = frames(spark, [trade("2024-01-14 10:00:00")], [price("2024-01-14 10:30:00")])
    trades, prices = JB.trades_table(spark, path=scratch_path(spark, "v-t")), JB.prices_table(spark, path=scratch_path(spark, "v-p"))
    with pytest.raises(ValueError):
        JB.daily_load(spark, t, p, trades, prices, dt.date(2024, 1, 15), views_db="anything")


def test_report_names_namespace_and_source(spark):
    db = TB.create_namespace(spark, f"report_{uuid.uuid4().hex[:6]}")
    table = JB.trades_table(spark, name=f"{db}.trades")
    report = LD.insert_if_absent(spark, _rows(spark), table, source_id="export-7").as_dict()
    assert (report["schema"], report["query_id"], report["total_rows"], report["inserted_rows"]) == (db, "export-7", 4, 3)
    assert LD.seed_table(spark, table, _rows(spark)).total_rows == 0
    empty = JB.trades_table(spark, path=scratch_path(spark, "seeded"))
    assert LD.seed_table(spark, empty, _rows(spark)).inserted_rows == 3
