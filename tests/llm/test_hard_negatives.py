import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tradelens.llm import hard_negatives as H
from tradelens.llm import queries as Q

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, k=5, n=5, low=80, high=100):
    """``rows``: (id, vector, label)."""
    ok = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, tuple(math.floor(256 * float(x)) for x in v), label)
        if row not in ok:
            ok.append(row)
    out = []
    for a, va, la in ok:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in ok if i != a and len(v) == len(va))
        for s, p, _ in [r for r in scored if r[2] == la][:k]:
            inside = [r for r in scored if r[2] != la and low * -s <= 100 * -r[0] <= high * -s]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(inside[:n], 1)]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("n,m,d", [(1, 1, 1), (5, 7, 3), (33, 40, 35), (64, 64, 64), (101, 67, 45), (0, 4, 3), (40, 50, 0)])
def test_strassen_products_are_exact(n, m, d):
    rng = np.random.default_rng(n)
    a, b = rng.integers(-2**27, 2**27, (n, d)), rng.integers(-2**27, 2**27, (m, d))
    for leaf in (1, 2, 8):
        assert (H.strassen(a, b, leaf) == a @ b.T).all()


def test_heaps_of_parts_merge_to_the_heap_of_all():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(-4, 4, (6, 50)), rng.permutation(50)
    allowed = rng.random((6, 50)) < 0.7
    whole, merged = H.Heaps(6, 4), H.Heaps(6, 4)
    whole.offer(scores, ids, allowed)
    for t in range(0, 50, 7):
        part = H.Heaps(6, 4)
        part.offer(scores[:, t:t + 7], ids[t:t + 7], allowed[:, t:t + 7])
        merged.merge(part)
    want = [(r, -s, i) for r in range(6)
            for s, i in sorted((-scores[r, j], ids[j]) for j in range(50) if allowed[r, j])[:4]]
    for h in (whole, merged):
        assert list(zip(h.row.tolist(), h.score.tolist(), h.id.tolist())) == want


def test_small_tiles_of_a_pair(monkeypatch):
    rng = np.random.default_rng(5)
    ids, labels, x = np.arange(30), rng.integers(0, 3, 30), rng.integers(-9, 30, (30, 6))
    whole = H.positive_heaps((ids[:9], labels[:9], x[:9]), (ids, labels, x), 4)
    args = ((ids[:9], labels[:9], x[:9]), (ids, labels, x), whole.row, whole.score, 3, 50, 100)
    windows = H.window_heaps(*args)
    assert len(windows.row) > 10
    monkeypatch.setattr(H, "ROWS", 2)
    monkeypatch.setattr(H, "COLUMNS", 4)
    for a, b in ((whole, H.positive_heaps(*args[:2], 4)), (windows, H.window_heaps(*args))):
        assert (a.row.tolist(), a.score.tolist(), a.id.tolist()) == (b.row.tolist(), b.score.tolist(), b.id.tolist())


SCHEMA = "vec_id long, embedding array<float>, label int, rank int, tile string"


def test_nulls_ties_repeats_lengths_and_clashing_names(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.integers(-2, 5, 4) / 8], int(rng.choice([0, 0, 0, 1, 2]))) for i in range(60)]
    rows += [(100, [0.5, 0.5, 0.5, 0.5], 0), (101, [0.5, 0.5, 0.5, 0.5], 0), (102, [0.5, 0.5, 0.5, 0.5], 1)] * 2
    rows += [(110, None, 0), (111, [0.1, None, 0.2, 0.3], 0), (112, [float("nan"), 1, 1, 1], 0), (113, [float("inf"), 1, 1, 1], 1),
             (114, [1.0, 1, 1, 1], None), (None, [1.0, 1, 1, 1], 0), (115, [], 0), (120, [1.0, 1.0], 0), (121, [1.0, 1.5], 0),
             (122, [0.9, 1.0], 3), (59, [0.25, 0.5, 0.5, 1.0], 1), (130, [0.0] * 4, 0), (131, [-1.0] * 4, 7)]
    df = spark.createDataFrame([(i, v and [x and float(x) for x in v], label, 1, "t") for i, v, label in rows], SCHEMA)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 20
    for small in (4_096, 3):
        monkeypatch.setattr(H, "SMALL", small)
        assert _rows(H.hard_negatives(df, F.col("vec_id") % 10 == 0)) == want
    assert _rows(H.hard_negatives(df, F.col("vec_id") % 10 == 0, 2, 3, low=50, high=90)) == brute(
        rows, lambda i: i % 10 == 0, 2, 3, 50, 90)
    assert _rows(H.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0)) == []
    assert _rows(H.hard_negatives(df, F.lit(None).cast("boolean"))) == []


def test_scores_beyond_64_bits_raise(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0], 0, 1, ""), (1, [1.0, 1.0], 0, 1, "")], SCHEMA)
    with pytest.raises(OverflowError):
        H.hard_negatives(df, F.col("vec_id") == 0)


def test_large_components_are_exact(spark):
    rows = [(i, [float(i * 1000 + 0.5), float(7 * i)], i % 2) for i in range(40)]
    df = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
    assert _rows(H.hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_query_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert _rows(Q.q_hard_negatives(spark, SF_SMALL)) == brute(rows, lambda i: i % 100 == 0)
