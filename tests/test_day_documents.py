"""Documents by key and day, read and streamed as a Spark data source over a transport."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tradelens import jobs as JB
from tradelens.session import scratch_path
from tradelens.sources import day_documents as DD
from tradelens.sources import trades as TR
from tradelens.streaming import price_stream as ST

from helpers import TRADE_SCHEMA, trade

DAY = 86_400_000
FIRST = dt.date(2024, 1, 1)
MS = 1_704_067_200_000
COINS = ["ethereum", "usd coin", "a/b=c%"]


def _doc(day, value):
    at = MS + day * DAY
    return json.dumps({"prices": [[at, value]], "market_caps": [[at, 1.0]], "total_volumes": [[at, 2.0]]})


def _landed(spark, root, days, coins=COINS, text=None):
    rows = [(c, FIRST + dt.timedelta(days=d), text or _doc(d, float(d))) for c in coins for d in days]
    DD.land_by_day(spark.createDataFrame(rows, "key string, day date, doc string"), root)


def _options(coins=COINS, **more):
    return {"keys": json.dumps(coins), "first": "2024-01-01"} | more


def _read(spark, name, **options):
    return spark.read.format(name).options(**options).load()


@pytest.mark.parametrize("days", ["1", "3", "100"])
def test_windows_hold_their_days_only(spark, days):
    root = scratch_path(spark, "by-day")
    _landed(spark, root, range(-1, 6))
    name = DD.register(spark, DD.FolderTransport(root), f"by_day_{days}")
    rows = _read(spark, name, **_options(end="2024-01-06", days=days)).collect()
    assert sorted((r.key, r.doc) for r in rows) == sorted((c, _doc(d, float(d))) for c in COINS for d in range(5))
    assert _read(spark, name, **_options(["ethereum", "ethereum", "none"], end="2024-01-03")).count() == 2
    for empty in (_options([], end="2024-01-03"), _options(end="2024-01-01"), _options(end="2023-01-01"), _options(["none"], end="2024-02-01")):
        assert _read(spark, name, **empty).collect() == []


def test_a_day_of_many_files_is_many_partitions(spark):
    root = scratch_path(spark, "by-day-hot")
    for _ in range(3):
        _landed(spark, root, [0], ["ethereum"])
    request = DD._Request(DD.FolderTransport(root, piece_bytes=1), _options(["ethereum", "none"]))
    windows = request.windows(FIRST, FIRST + dt.timedelta(days=2))
    assert len(windows) == 3 and len([r for w in windows for r in request.rows(w)]) == 3
    assert len(DD._Request(DD.FolderTransport(root), _options(["ethereum"])).windows(FIRST, FIRST + dt.timedelta(days=1))) == 1


def test_whole_files_and_blank_lines(spark, tmp_path):
    folder = tmp_path / "coin=ethereum" / "day=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("{\n \"prices\": null}\n")
    (folder / "b.json").write_bytes(b"\n  \n")
    (folder / "_SUCCESS").write_text("x")
    name = DD.register(spark, DD.FolderTransport(str(tmp_path), whole=True), "whole_files")
    rows = _read(spark, name, **_options(["ethereum"], end="2024-01-02")).collect()
    assert [r.doc for r in rows] == ["{\n \"prices\": null}\n"] and rows[0].file.endswith("a.json")
    name = DD.register(spark, DD.FolderTransport(str(tmp_path)), "lines_of_files")
    assert sorted(r.doc for r in _read(spark, name, **_options(["ethereum"], end="2024-01-02")).collect()) == [" \"prices\": null}", "{"]


def test_a_stream_takes_each_complete_day_once(spark):
    root, base = scratch_path(spark, "by-day-stream"), scratch_path(spark, "by-day-tables")
    prices, bad = JB.prices_table(spark, path=f"{base}/p"), JB.rejected_table(spark, path=f"{base}/r")
    name, reports = DD.register(spark, DD.FolderTransport(root), "by_day_stream"), []

    def run(**more):
        ST.stream_day_documents(spark, name, _options(**more), prices, bad, f"{base}/cp",
                                on_batch=lambda _, r: reports.append((r.loaded, r.rejected))).awaitTermination()
        done, reports[:] = [sum(x) for x in zip(*reports, strict=True)] or [0, 0], []
        return done

    assert run() == [0, 0]                                   # nothing has landed
    _landed(spark, root, range(3))
    assert run() == [2 * len(COINS), 0]                      # the last day may still grow
    _landed(spark, root, [2], ["ethereum"], "not json")
    _landed(spark, root, [3, 4])
    assert run(end="2024-01-04") == [len(COINS), 1]          # bounded by ``end``
    assert run() == [len(COINS), 0]                          # goes on where it stopped
    assert prices.read().count() == 4 * len(COINS)
    assert prices.read().where("coin = 'a/b=c%'").select(F.max("date_time")).first()[0] == "2024-01-04 00:00:00"
    assert [r.coin for r in bad.read().collect()] == ["ethereum"]


def test_another_transport(spark):
    class Numbered(DD.Transport):
        def pieces(self, key, first, end):
            return [str(i) for i in range(3)]

        def documents(self, key, first, end, piece):
            yield f"{key}/{piece}", f"{first} {end}"

    name = DD.register(spark, Numbered(), "numbered")
    rows = _read(spark, name, **_options(["x", "y"], end="2024-01-04", days="2")).collect()
    assert len(rows) == 12 and {r.doc for r in rows} == {"2024-01-01 2024-01-03", "2024-01-03 2024-01-04"}
    with pytest.raises(NotImplementedError):
        Numbered().complete_until(["x"])


def test_options_are_checked(spark):
    ask = DD.FolderTransport("/nowhere")
    for options in ({}, {"keys": "[]"}, _options(days="0"), _options(first="soon"), {"keys": "ethereum", "first": "2024-01-01"}):
        with pytest.raises(ValueError):
            DD._Request(ask, options)
    with pytest.raises(ValueError):
        DD._Reader(DD._Request(ask, _options()))


def test_trades_come_back_as_they_were(spark):
    root = scratch_path(spark, "trades-by-day")
    rows = [trade("2024-01-01 10:00:00.123456", tx_hash="ü\n1"), trade("2024-01-02 00:00:00", buy_price=0.1, units_sold=None),
            trade("2024-01-02 00:00:00", sell_token="WETH", buy_token="USDC", tx_hash=None)]
    frame = spark.createDataFrame(rows, TRADE_SCHEMA)
    DD.land_by_day(TR.trade_docs(frame), root, "direction")
    name = DD.register(spark, DD.FolderTransport(root, "direction"), "trades_by_day")
    back = TR.parse_trade_docs(_read(spark, name, **_options(["USDC-WETH", "WETH-USDC"], end="2024-01-03")))
    assert back.schema.simpleString() == frame.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.collect()))
