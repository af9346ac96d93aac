"""Price documents that do not load are kept with file and reason; the others load."""

import json

from tradelens import jobs as JB
from tradelens.session import scratch_path
from tradelens.sources import prices as PR
from tradelens.streaming import price_stream as ST

MS = 1_704_067_200_000
GOOD = json.dumps({"prices": [[MS, 1.5], [MS + 3_600_000, 2.5]], "market_caps": [[MS, 1], [MS, 2]], "total_volumes": [[MS, 3], [MS, 4]]})
EMPTY = json.dumps({"prices": [], "market_caps": [], "total_volumes": []})
BAD = {
    '{"prices": [[1': PR.NOT_JSON, "plain text": PR.NOT_JSON, "[1, 2]": PR.NOT_JSON, '{"error": {"code": 429}}': PR.NO_PRICES,
    "{}": PR.NO_PRICES, '{"prices": null}': PR.NO_PRICES, '{"prices": [[1, 2]]}': PR.UNEQUAL,
    '{"prices": [[1, 2]], "market_caps": [[1, 2], [3, 4]], "total_volumes": [[1, 2]]}': PR.UNEQUAL,
    '{"prices": [[null, 2]], "market_caps": [[1, 2]], "total_volumes": [[1, 2]]}': PR.NO_TIME,
    '{"prices": "many", "market_caps": [], "total_volumes": []}': PR.NOT_JSON,
}


def _landed(spark, name):
    base = scratch_path(spark, name)
    docs = [("ethereum", d) for d in (GOOD, EMPTY, *BAD)] + [("usd-coin", GOOD), ("usd-coin", "  "), ("usd-coin", "{}")]
    ST.land_price_docs(spark.createDataFrame(docs, "coin string, doc string"), f"{base}/landing")
    return base, JB.prices_table(spark, path=f"{base}/prices"), JB.rejected_table(spark, path=f"{base}/rejected")


def test_every_document_loads_or_is_kept_with_its_reason(spark):
    base, prices, rejected = _landed(spark, "docs-batch")
    for first in (True, False):                       # a replay adds nothing
        done = JB.load_price_docs(spark, PR.landed_docs(spark, f"{base}/landing"), prices, rejected)
        assert (done.documents, done.loaded, done.rejected) == (len(BAD) + 4, 3, len(BAD) + 1)
        assert done.points.inserted_rows == (4 if first else 0) and done.quarantine.inserted_rows == (len(BAD) + 1 if first else 0)
    rows = rejected.read().collect()
    assert {r.doc: r.reason for r in rows if r.coin == "ethereum"} == BAD
    assert [r.doc for r in rows if r.coin == "usd-coin"] == ["{}"]
    assert all(f"coin={r.coin}" in r.file for r in rows)
    assert sorted((r.coin, r.prices) for r in prices.read().collect()) == [
        ("ethereum", 1.5), ("ethereum", 2.5), ("usd-coin", 1.5), ("usd-coin", 2.5)]


def test_whole_files_named_after_their_coin(spark, tmp_path):
    (tmp_path / "ethereum_1.json").write_text(json.dumps(json.loads(GOOD), indent=2))
    (tmp_path / "ethereum_2.json").write_text("{\n \"prices\": [[1,\n")
    (tmp_path / "empty_1.json").write_text("")
    base = scratch_path(spark, "docs-files")
    prices, rejected = JB.prices_table(spark, path=f"{base}/p"), JB.rejected_table(spark, path=f"{base}/r")
    docs = PR.landed_docs(spark, str(tmp_path), multi_line=True, coin_from="file_name")
    done = JB.load_price_docs(spark, docs, prices, rejected)
    assert (done.documents, done.loaded, done.rejected) == (2, 1, 1)
    assert rejected.read().first().file.endswith("ethereum_2.json")


def test_stream_keeps_what_does_not_load_and_reports_each_batch(spark):
    base, prices, rejected = _landed(spark, "docs-stream")
    reports = []
    for run in range(2):
        ST.stream_price_docs(spark, f"{base}/landing", prices, f"{base}/cp-{run}", max_files_per_trigger=1, rejected=rejected,
                             on_batch=lambda epoch, r: reports.append((epoch, r))).awaitTermination()
    assert sum(r.documents for _, r in reports) == 2 * (len(BAD) + 4) and sum(r.rejected for _, r in reports) == 2 * (len(BAD) + 1)
    assert sum(r.points.inserted_rows for _, r in reports) == 4 and rejected.read().count() == len(BAD) + 1
    assert len(reports) > 2 and {e for e, _ in reports} == set(range(len(reports) // 2))


def test_no_document(spark):
    base = scratch_path(spark, "docs-none")
    prices, rejected = JB.prices_table(spark, path=f"{base}/p"), JB.rejected_table(spark, path=f"{base}/r")
    none = spark.createDataFrame([], "coin string, file string, doc string")
    done = JB.load_price_docs(spark, none, prices, rejected)
    assert (done.documents, done.loaded, done.rejected) == (0, 0, 0) and rejected.read().count() == 0
