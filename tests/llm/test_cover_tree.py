import math

import numpy as np
import pytest

from tradelens.llm import cover_tree as CT


def brute(rows, queries, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in ok:
        if i in queries:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, queries, k, monkeypatch, block=40):
    monkeypatch.setattr(CT, "DATA_BLOCK", block)
    monkeypatch.setattr(CT, "QUERY_BLOCK", 11)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = CT.top_k(df.where(df.vec_id.isin(queries)), df, k).collect()
    return sorted(tuple(r) for r in got)


def test_clusters_ties_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 8)) * 2
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.1).astype(np.float32).tolist()) for i in range(230)]
    rows += [(i, rows[7][1]) for i in range(300, 390)]  # one very common vector, larger than a block
    rows += [(400, None), (401, []), (402, [1.0] * 7 + [None]), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
             (405, [0.5, 0.25, 1.0]), (406, [1.0, 2.0, 3.0]), (None, rows[0][1]), (407, [0.0] * 8), (408, [3e9, 1e3, 5.0])]
    queries = [*range(0, 230, 9), 305, 310, 400, 402, 405, 406, 407, 408]
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], queries, 4)
    assert run(spark, rows, queries, 4, monkeypatch) == want


def test_fewer_than_k_and_empty(spark, monkeypatch):
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (3, [1.0, 1.0])]
    assert run(spark, rows, [1, 3], 5, monkeypatch) == brute(rows, [1, 3], 5)
    assert run(spark, rows, [99], 5, monkeypatch) == []
    assert run(spark, [], [1], 5, monkeypatch) == []


@pytest.mark.parametrize("spread", [0.02, 5.0])
def test_tree_radii_cover_and_search_prunes(spread):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 6)) * 500
    x = np.floor(centers[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 6)) * spread * 100).astype(np.int64)
    q = x[::50]
    qt, rt = CT.Tree(q, leaf=4), CT.Tree(x, leaf=8)
    def apart(a, b):
        return np.sqrt(((rt.center[a] - rt.center[b])**2).sum())
    for n, children in enumerate(rt.children):
        rows = rt.x[rt.order[rt.start[n]:rt.end[n]]]
        assert np.sqrt(((rows - rt.center[n])**2).sum(axis=1)).max() <= rt.radius[n] + 1e-9 <= 2.0**rt.level[n] + 1e-6
        if children:
            assert sum(rt.end[c] - rt.start[c] for c in children) == rt.end[n] - rt.start[n]
        for i, c in enumerate(children):
            assert apart(n, c) <= 2.0**rt.level[n]
            for d in children[:i]:
                # Centres are separated; the leaf of single rows has its parent's centre.
                assert apart(c, d) > 2.0**(rt.level[n] - 1) or apart(n, c) == 0 or apart(n, d) == 0
    best = CT.Best(len(q), 3)
    ids, q_ids = np.arange(3000), np.arange(0, 3000, 50)
    compared = CT.search(qt, q, q_ids, rt, x, ids, best)
    s = CT.scores(q, x)
    s[np.arange(60), q_ids] = CT.NONE
    for i in range(60):
        order = np.lexsort((ids, ~s[i]))[:3]
        assert best.id[i].tolist() == order.tolist() and best.score[i].tolist() == s[i][order].tolist()
    leaves = sum(not c for c in qt.children) * sum(not c for c in rt.children)
    assert compared < leaves * (0.2 if spread < 1 else 0.8)
