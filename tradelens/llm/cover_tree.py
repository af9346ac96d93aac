"""Exact top-k search by inner product with dual cover trees.

Vectors are turned into integers, so scores are exact.  Queries and data are indexed alike:

* A bounded sample gives ``CELLS`` pivots (farthest-first, the top of the cover tree); every
  vector goes to its nearest pivot.  Neighbouring cells are packed into blocks; a cell larger
  than a block, such as many copies of one vector, is split by a hash of the ids.
* Inside a block a cover tree is built (nested, covering and separated centres); every node
  knows its covering radius and a contiguous range of vectors.
* A query block first meets the data block nearest to it, which gives every query a first
  worst kth score.  Block pairs whose bound cannot reach the worst of them are dropped; the
  others are searched with both trees together: a pair of nodes is pruned if

      <q, r> <= <cq, cr> + |cq| * rr + |cr| * rq + rq * rr

  (centres c, covering radii r) is below the worst kth score of every query under the node.
* Each pair of blocks returns at most k rows per query, which are merged.

Ties go to the smaller id.  Vectors that are null, or hold null or non-finite components, take
no part, and vectors of another length are no candidates.  Repeated rows are separate
candidates; a row is no candidate of its own id.  Null ids take no part.  Fewer than k
candidates: all are returned; empty tables give no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bound of the index's sample, and the pivots taken from it.
SAMPLE, CELLS = 4_096, 64
DATA_BLOCK, QUERY_BLOCK, LEAF = 4_096, 1_024, 64
#: Block summaries that one task compares at a time.
SUMMARIES = 512
NONE = np.iinfo(np.int64).min


def scaled(embedding: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as long; null if the vector takes no part."""
    x = embedding.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & (F.size(x) > 0) & ~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


# --------------------------------------------------------------------------- trees in a block

class Tree:
    """A cover tree over the rows of ``x``; ``order`` lists the rows node by node.

    A node at level i has one of its rows as centre and covers rows within 2**i of it.  Its
    children's centres are chosen among its rows, its own centre first (nesting), farthest
    first, until every row is within 2**(i-1) of one (covering); so they are more than
    2**(i-1) apart (separation).  Levels with a single child are skipped.  Nodes of at most
    ``leaf`` rows, and of equal rows, are leaves; children of a single row are kept together
    as one leaf with their parent's centre, so they are compared in one product."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x.astype(np.float64)
        self.square = (self.x**2).sum(axis=1)
        self.order = np.arange(len(x))
        self.start, self.end, self.center, self.radius, self.level, self.children = [], [], [], [], [], []
        root = int(((self.x - self.x.mean(axis=0))**2).sum(axis=1).argmin())
        stack = [(self._node(0, len(x), root), root)]
        while stack:
            node, center = stack.pop()
            a, b = self.start[node], self.end[node]
            if b - a <= leaf or self.radius[node] == 0:
                continue
            rows = self.order[a:b].copy()
            centers, near = self._deal(rows, center, 2.0**(2 * (self.level[node] - 1)))
            alone = np.bincount(near, minlength=len(centers)) == 1
            if len(centers) == 1 or alone.all():
                continue
            group = np.where(alone[near], len(centers), near)
            by = np.argsort(group, kind="stable")
            self.order[a:b] = rows[by]
            names, first = np.unique(group[by], return_index=True)
            for k, lo, hi in zip(names, first, np.append(first[1:], b - a), strict=True):
                together = k == len(centers)
                child = self._node(a + lo, a + hi, center if together else centers[k])
                self.children[node].append(child)
                if not together:
                    stack.append((child, centers[k]))
        self.start, self.end = np.array(self.start), np.array(self.end)
        self.center, self.radius = np.array(self.center), np.array(self.radius)

    def _squares(self, rows: np.ndarray, row: int) -> np.ndarray:
        return np.maximum(self.square[rows] - 2 * (self.x[rows] @ self.x[row]) + self.square[row], 0)

    def _node(self, a: int, b: int, row: int) -> int:
        # The difference is exact where squares of large components would round.
        far = float(np.sqrt(((self.x[self.order[a:b]] - self.x[row])**2).sum(axis=1).max()))
        self.start.append(a)
        self.end.append(b)
        self.center.append(self.x[row])
        self.radius.append(far)
        self.level.append(int(np.ceil(np.log2(far))) if far else 0)
        self.children.append([])
        return len(self.radius) - 1

    def _deal(self, rows: np.ndarray, center: int, reach: float) -> tuple[list[int], np.ndarray]:
        """Centres among ``rows`` and each row's nearest; ``reach``: the squared distance kept."""
        centers, far, near = [center], self._squares(rows, center), np.zeros(len(rows), np.int64)
        while True:
            pick = int(far.argmax())
            if far[pick] <= reach:
                return centers, near
            d = self._squares(rows, rows[pick])
            closer = d < far
            if not closer[pick]:  # components too large for exact squares
                return centers, near
            near[closer] = len(centers)
            far[closer] = d[closer]
            centers.append(int(rows[pick]))


class Best:
    """The k best ``(score, id)`` per query: larger scores, then smaller ids.  Candidates under
    a query's ``floor`` are known not to be among them."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, NONE) if floor is None else floor
        self.k = k

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def merge(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Offer candidates ``ids`` with ``score[row, candidate]`` (``NONE``: no candidate)."""
        least = self.worst(rows)
        if score.shape[1] > self.k:
            # Everything at least as good as the kth best: ties are settled by id below.
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        r, c = np.nonzero((score >= least[:, None]) & (score > NONE))
        if not len(r):
            return
        hit = np.unique(r)
        at = np.concatenate([np.repeat(hit, self.k), r])
        s = np.concatenate([self.score[rows[hit]].ravel(), score[r, c]])
        i = np.concatenate([self.id[rows[hit]].ravel(), ids[c]])
        by = np.lexsort((i, ~s, at))  # ~s = -s - 1 reverses the order without overflow
        at, s, i = at[by], s[by], i[by]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < self.k
        self.score[rows[at[keep]], rank[keep]] = s[keep]
        self.id[rows[at[keep]], rank[keep]] = i[keep]


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: by float products while every sum stays below 2**53."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if largest < 2.0**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def search(qt: Tree, q: np.ndarray, q_ids: np.ndarray, rt: Tree, r: np.ndarray, r_ids: np.ndarray, best: Best) -> int:
    """Dual-tree search of all queries of ``qt`` in ``rt``; returns the leaf pairs compared."""
    compared = 0

    def bounds(a: int, nodes: list[int]) -> np.ndarray:
        return reach(qt.center[a], qt.radius[a], rt.center[nodes], rt.radius[nodes])

    heap = [(-float(bounds(0, [0])[0]), 0, 0)]
    while heap:
        bound, a, b = heapq.heappop(heap)
        rows = qt.order[qt.start[a]:qt.end[a]]
        if -bound < best.worst(rows).min():
            continue
        qa, rb = qt.children[a], rt.children[b]
        if not qa and not rb:
            cand = rt.order[rt.start[b]:rt.end[b]]
            for at in range(0, len(cand), 4_096):  # a leaf of equal vectors can be large
                some = cand[at:at + 4_096]
                found = scores(q[rows], r[some])
                found[q_ids[rows][:, None] == r_ids[some][None, :]] = NONE
                best.merge(rows, found, r_ids[some])
            compared += 1
            continue
        # Descend the wider of the two.
        if rb and (not qa or rt.radius[b] >= qt.radius[a]):
            for child, up in zip(rb, bounds(a, rb), strict=True):
                heapq.heappush(heap, (-float(up), a, child))
        else:
            for child in qa:
                heapq.heappush(heap, (-float(bounds(child, [b])[0]), child, b))
    return compared


def reach(cq: np.ndarray, rq: float, cr: np.ndarray, rr: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products between a ball and each of several balls, with room
    for the rounding of the floating-point sums."""
    nq, nr = float(np.sqrt((cq**2).sum())), np.sqrt((cr**2).sum(axis=1))
    return cr @ cq + nq * rr + nr * rq + rq * rr + 1e-6 + 1e-9 * (nq + rq) * (nr + rr)


# --------------------------------------------------------------------------- blocks

def pivots(vectors: DataFrame, sample: int = SAMPLE, cells: int = CELLS) -> dict[int, np.ndarray]:
    """Per vector length: farthest-first pivots of a sample of at most ``sample`` vectors, those
    with the smallest id hash per slot."""
    slot = F.pmod(F.xxhash64("id"), F.lit(sample))
    rows = vectors.groupBy(slot.alias("slot")).agg(F.min(F.struct(F.xxhash64(F.lit(3), "id").alias("h"), "id", "v")).alias("m"))
    by: dict[int, list] = {}
    for r in rows.select("m.id", "m.v").collect():
        by.setdefault(len(r[1]), []).append((r[0], r[1]))
    out = {}
    for n, found in sorted(by.items()):
        x = np.array([v for _, v in sorted(found)], float)
        chosen = [0]
        far = ((x - x[0])**2).sum(axis=1)
        while len(chosen) < min(cells, len(x)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]])**2).sum(axis=1))
        # Each pivot is followed by the nearest one left, so that cells packed together are near.
        order, left = [chosen[0]], chosen[1:]
        while left:
            order.append(left.pop(int(((x[left] - x[order[-1]])**2).sum(axis=1).argmin())))
        out[n] = x[order]
    return out


def with_cells(vectors: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``len`` and ``cell``: the nearest pivot of the vector's length (0 if it has none)."""
    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int32)
        size = v.map(len).to_numpy()
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            c = centers.get(int(n))
            if c is not None:
                x = np.stack(v.to_numpy()[rows]).astype(float)
                out[rows] = ((c**2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
        return pd.Series(out, index=v.index)

    return vectors.withColumns({"len": F.size("v"), "cell": nearest("v")})


def blocks(cells: DataFrame, size: int) -> DataFrame:
    """``(block, len, n, ids, vectors, center, radius)``: blocks of about ``size`` vectors.

    The cell counts (at most ``CELLS`` per vector length) are summed in cell order: small cells
    share a block, a large one is split by a hash of the ids."""
    counts = cells.groupBy("len", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("len").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = counts.withColumn("first", (F.coalesce(F.sum("n").over(before), F.lit(0)) / size).cast("long")).withColumn(
        "parts", F.ceil(F.col("n") / size).cast("long"))
    rows = cells.join(F.broadcast(plan.drop("n")), ["len", "cell"])
    rows = rows.select("len", F.when(F.col("parts") <= 1, F.struct(F.lit(-1).alias("cell"), F.col("first").alias("part"))).otherwise(
        F.struct("cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))).alias("spot"), "id", "v")
    rows = rows.withColumn("block", F.concat_ws(":", "len", "spot.cell", "spot.part"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["v"].to_numpy()).astype(np.int64)
        ids = pdf["id"].to_numpy(np.int64)
        by = np.argsort(ids, kind="stable")
        x, ids = x[by], ids[by]
        c = x.mean(axis=0)
        small = np.abs(x).max() < 2**31
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "len": [int(pdf["len"].iloc[0])], "n": [len(x)],
                             "ids": [ids.tobytes()], "vectors": [x.astype(np.int32 if small else np.int64).tobytes()],
                             "center": [c.tolist()], "radius": [float(np.sqrt(((x - c)**2).sum(axis=1).max()))]})

    return rows.drop("spot").groupBy("block").applyInPandas(
        pack, "block string, len int, n int, ids binary, vectors binary, center array<double>, radius double")


def _unpacked(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    kind = np.int32 if len(vectors) == 4 * width * len(ids) else np.int64
    return ids, np.frombuffer(vectors, kind).reshape(len(ids), width)


def _met(queries: DataFrame, data: DataFrame, judge, kind: str) -> DataFrame:
    """``judge(query summary, data summaries)`` for every query block and group of data blocks.

    Data block summaries are gathered in groups of about ``SUMMARIES``; each query summary is
    sent to each group of its vector length."""
    summary = data.select("block", "len", "center", "radius")
    groups = -(-summary.count() // SUMMARIES)
    if not groups:
        return None
    packed = summary.groupBy("len", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")).agg(
        F.collect_list(F.struct("block", "center", "radius")).alias("found"))
    sent = queries.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for q in pdf.itertuples():
                names = [d["block"] for d in q.found]
                center = np.array([d["center"] for d in q.found], float)
                radius = np.array([d["radius"] for d in q.found], float)
                rows += [(q.block, *r) for r in judge(q, names, center, radius)]
            yield pd.DataFrame(rows, columns=["qb", "db", "value"])

    return sent.join(packed, ["len", "group"]).mapInPandas(run, f"qb string, db string, value {kind}")


def _nearest(q, names, center, radius):
    d = ((center - np.asarray(q.center, float))**2).sum(axis=1)
    i = int(d.argmin())
    return [(names[i], float(d[i]))]


def _reachable(q, names, center, radius):
    up = reach(np.asarray(q.center, float), q.radius, center, radius)
    return [(n, float(u)) for n, u in zip(names, up, strict=True) if u >= q.worst]


_FOUND = "qb string, q_row int, query_id long, vec_id long, score long"


def _searched(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The at most k best per query of every pair of blocks ``(qb, db, floor)``."""
    left = queries.select(F.col("block").alias("qb"), "len", F.col("ids").alias("q_ids"), F.col("vectors").alias("q"))
    right = data.select(F.col("block").alias("db"), F.col("ids").alias("r_ids"), F.col("vectors").alias("r"))
    rows = pairs.join(left, "qb").join(right, "db").select("qb", "len", "floor", "q_ids", "q", "r_ids", "r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qb, width, floor, *packed = (batch.column(j)[i].as_py() for j in range(7))
                q_ids, q = _unpacked(packed[0], packed[1], width)
                r_ids, r = _unpacked(packed[2], packed[3], width)
                best = Best(len(q), k, np.frombuffer(floor, np.int64) if floor else None)
                search(Tree(q), q, q_ids, Tree(r), r, r_ids, best)
                row, rank = np.nonzero(best.score > NONE)
                yield pa.RecordBatch.from_arrays([
                    pa.array([qb] * len(row), pa.string()), pa.array(row.astype(np.int32)), pa.array(q_ids[row]),
                    pa.array(best.id[row, rank]), pa.array(best.score[row, rank])],
                    ["qb", "q_row", "query_id", "vec_id", "score"])

    return rows.mapInArrow(run, _FOUND)


def _floors(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(block, floor, worst)``: each query's kth score so far (packed), and the least."""
    kth = found.groupBy("qb", "q_row").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    kth = kth.where(F.col("n") >= k).groupBy("qb").agg(F.collect_list(F.struct("q_row", "kth")).alias("rows"))
    rows = queries.select("block", "n").join(kth.withColumnRenamed("qb", "block"), "block", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                floor = np.full(r.n, NONE)
                for x in r.rows if r.rows is not None else ():
                    floor[x["q_row"]] = x["kth"]
                out.append((r.block, floor.tobytes(), float(floor.min())))
            yield pd.DataFrame(out, columns=["block", "floor", "worst"])

    return rows.mapInPandas(run, "block string, floor binary, worst double")


def top_k(queries: DataFrame, data: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k largest inner products in ``data``."""
    if k < 1:
        raise ValueError("k must be at least 1")

    def prepared(df):
        v = df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"))
        return v.where("id is not null and v is not null")

    name = "cover-tree"
    data, queries = prepared(data), prepared(queries)
    centers = pivots(data)
    data = stored(blocks(with_cells(data, centers), DATA_BLOCK), f"{name}-data")
    queries = stored(blocks(with_cells(queries, centers), QUERY_BLOCK), f"{name}-queries")
    summary = queries.select("block", "len", "center", "radius")
    near = _met(summary, data, _nearest, "double")
    if near is None:
        empty = queries.select(F.lit(None).cast("long").alias("query_id"), F.lit(0).alias("rank"),
                               F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("score"))
        return empty.where("false")
    near = stored(near.groupBy("qb").agg(F.min_by("db", F.struct("value", "db")).alias("db")).select(
        "qb", "db", F.lit(None).cast("binary").alias("floor")), f"{name}-nearest")
    first = stored(_searched(near, queries, data, k), f"{name}-first")
    floors = stored(_floors(first, queries, k), f"{name}-floors")
    pairs = _met(summary.join(floors.select("block", "worst"), "block"), data, _reachable, "double")
    pairs = pairs.join(near.select("qb", "db"), ["qb", "db"], "left_anti").join(
        floors.select(F.col("block").alias("qb"), "floor"), "qb").select("qb", "db", "floor")
    found = first.unionByName(stored(_searched(stored(pairs, f"{name}-pairs"), queries, data, k), f"{name}-second"))
    order = Window.partitionBy("qb", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
