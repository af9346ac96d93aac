"""Hard negatives by Strassen products of integer tiles and mergeable heaps.

Vectors become integers, so scores (inner products) are exact.  An anchor's positives are its
best rows of the same label; a positive's hard negatives are the best rows of other labels
whose score lies in a window below the positive's.

* Rows are dealt by ranges of (length, label, id) into tiles, anchors into blocks; either is
  packed into one row of narrow integers.  A label that holds a third of all rows fills many
  tiles.  Anchor blocks meet tiles in pairs, one bounded group per pair: first the pairs that
  share a label, for the positives, then all pairs, for the windows.
* Within a pair, int64 tiles are multiplied by Strassen's recursion: both sides are padded with
  zeros to even sizes and split in halves, seven products of halves replace eight, down to
  ``LEAF``.  Only additions and multiplications of integers are used; they are exact as long as
  the scores fit into 64 bits, which is checked on the data beforehand.
* The best rows are kept in heaps of bounded size, one per anchor (or per anchor and positive).
  A heap is merged with the next tile's rows, and the heaps of all pairs are merged by rank.

Rows: a null id, label or vector, an empty vector, and a vector with a null or non-finite
component take no part; rows equal in id, label and vector are one row.  Rows of the anchor's own
id and vectors of another length are no candidates.  Ties go to the smaller id.  Fewer rows than
asked for: all are returned; an anchor without positives, a positive without negatives and an
empty table give no row.  Scores that could exceed 64 bits raise ``OverflowError``.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .cover_tree import scaled

#: Packed bytes of a tile and of an anchor block, about, and the rows below which more tiles
#: than the session has shuffle partitions do not pay.
TILE_BYTES, BLOCK_BYTES, SMALL = 16_000_000, 4_000_000, 4_096
#: Anchors and candidates multiplied at a time; sizes at which the recursion ends.
ROWS, COLUMNS, LEAF = 128, 2_048, 32
NONE = np.iinfo(np.int64).min


# --------------------------------------------------------------------------- products

def _even(x: np.ndarray) -> np.ndarray:
    """``x`` with a row and a column of zeros added where its sizes are odd."""
    return np.pad(x, [(0, n % 2) for n in x.shape]) if any(n % 2 for n in x.shape) else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """All inner products of the rows of ``a`` with the rows of ``b`` (int64, exact modulo 2**64)."""
    n, m = len(a), len(b)
    if min(n, m, a.shape[1]) <= leaf:
        return a @ b.T
    a, b = _even(a), _even(b)
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    # Halves by rows and by components; b's halves are those of its transpose.
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, np.ascontiguousarray(b11), leaf)
    p3 = strassen(np.ascontiguousarray(a11), b12 - b22, leaf)
    p4 = strassen(np.ascontiguousarray(a22), b21 - b11, leaf)
    p5 = strassen(a11 + a12, np.ascontiguousarray(b22), leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


# --------------------------------------------------------------------------- heaps

class Heaps:
    """For each of ``n`` rows the ``k`` best (score, id): higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.row, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.worst = np.full(n, NONE)   # the kth score of full heaps

    def offer(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Candidate ``ids[j]`` with ``scores[i, j]`` for row i, where allowed."""
        scores = np.where(allowed & (scores >= self.worst[:, None]), scores, NONE)
        if scores.shape[1] > self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            row, col = np.nonzero((scores > NONE) & (scores >= kth[:, None]))
        else:
            row, col = np.nonzero(scores > NONE)
        if len(row):
            self._add(row, scores[row, col], ids[col])

    def merge(self, other: Heaps) -> None:
        self._add(other.row, other.score, other.id)

    def _add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        self.row, self.score, self.id = row[best], score[best], ids[best]
        full = place == self.k - 1
        self.worst[row[full]] = score[full]


def positive_heaps(anchors: tuple, tile: tuple, k: int) -> Heaps:
    """Each anchor's k best rows of its label; both sides are ``(ids, labels, vectors)``."""
    (ids, labels, x), (c_ids, c_labels, y) = anchors, tile
    out = Heaps(len(ids), k)
    for s in range(0, len(ids), ROWS):
        a_id, a_label, a = (v[s:s + ROWS] for v in (ids, labels, x))
        part = Heaps(len(a_id), k)
        for t in range(0, len(c_ids), COLUMNS):
            b_id, b_label = c_ids[t:t + COLUMNS], c_labels[t:t + COLUMNS]
            same = (a_label[:, None] == b_label) & (a_id[:, None] != b_id)
            if same.any():
                part.offer(strassen(a, y[t:t + COLUMNS]), b_id, same)
        part.row += s
        out.merge(part)
    return out


def window_heaps(anchors: tuple, tile: tuple, row: np.ndarray, top: np.ndarray, k: int, low: int, high: int) -> Heaps:
    """For positive j, of anchor ``row[j]`` (ascending) with score ``top[j]``, the k best rows of
    other labels with ``low * top <= 100 * score <= high * top``."""
    (ids, labels, x), (c_ids, c_labels, y) = anchors, tile
    out = Heaps(len(row), k)
    for s in range(0, len(ids), ROWS):
        first, last = np.searchsorted(row, [s, s + ROWS])
        if first == last:
            continue
        local, score = row[first:last] - s, top[first:last, None]
        a_label, a = labels[s:s + ROWS], x[s:s + ROWS]
        part = Heaps(last - first, k)
        for t in range(0, len(c_ids), COLUMNS):
            b_id, b_label = c_ids[t:t + COLUMNS], c_labels[t:t + COLUMNS]
            scores = strassen(a, y[t:t + COLUMNS])[local]
            inside = (100 * scores <= high * score) & (100 * scores >= low * score)
            part.offer(scores, b_id, inside & (a_label[local][:, None] != b_label))
        part.row += first
        out.merge(part)
    return out


# --------------------------------------------------------------------------- tiles

_TILE = "tile long, len int, ids binary, labels binary, vectors binary"


def tiles(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """``(id, label, v)`` dealt by range into about ``parts`` tiles, one packed row per tile and
    vector length; integers of ``width`` bytes."""
    size = F.size("v").alias("len")
    dealt = rows.select("id", "label", size, "v").repartitionByRange(
        parts, "len", "label", F.xxhash64("id"), F.xxhash64("v")).sortWithinPartitions("len", "label", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        tile = TaskContext.get().partitionId()
        held: dict[int, list] = {}
        for batch in batches:
            length = batch.column(2).to_numpy()
            for n in np.unique(length):
                some = batch.filter(pa.array(length == n))
                flat = some.column(3).flatten().to_numpy(zero_copy_only=False)
                held.setdefault(int(n), []).append((some.column(0).to_numpy(), some.column(1).to_numpy(),
                                                    flat.astype(f"<i{width}")))
        for n, groups in held.items():
            ids, labels, flat = (np.concatenate(g).tobytes() for g in zip(*groups, strict=True))
            yield pa.RecordBatch.from_pydict({"tile": [tile], "len": pa.array([n], pa.int32()), "ids": [ids],
                                              "labels": [labels], "vectors": [flat]})

    return dealt.mapInArrow(run, _TILE)


def _opened(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], f"<i{width}").astype(np.int64)
    return (np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), vectors.reshape(-1, row["len"]))


def _labels_of(packed: DataFrame, name: str) -> DataFrame:
    """``(name, len, label)``: the labels in each packed row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, n, labels in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = np.unique(np.frombuffer(labels, "<i8"))
                yield pa.RecordBatch.from_pydict({name: [tile] * len(found), "len": pa.array([n] * len(found), pa.int32()),
                                                  "label": found})

    return packed.select(name, "len", "labels").mapInArrow(run, f"{name} long, len int, label long")


def _met(blocks: DataFrame, packed: DataFrame, pairs: DataFrame, work, schema: str) -> DataFrame:
    """``work(block rows, tile rows)`` for every pair ``(block, tile)``, one group per pair."""
    left = blocks.join(pairs, "block").groupBy("block", "tile")
    right = packed.join(pairs, "tile").groupBy("block", "tile")
    return left.cogroup(right).applyInArrow(work, schema)


def _parts(n: int, row_bytes: int, target: int, at_least: int) -> int:
    return max(1, -(-n * row_bytes // target), min(at_least, -(-n // SMALL)))


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
                   high: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` selects the anchors among ``rows``.  Each anchor has ``n_positives`` positives,
    each of these ``n_negatives`` rows of other labels scoring ``low`` to ``high`` percent of it.
    """
    if min(n_positives, n_negatives) < 1:
        raise ValueError("n_positives and n_negatives must be at least 1")
    name, spark = "hard-negatives", rows.sparkSession
    kept = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       scaled(F.col(vector_col), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    kept = stored(kept.where("id is not null and label is not null and v is not null").distinct(), f"{name}-rows")
    peak = F.greatest(F.array_max("v"), -F.array_min("v"))
    seen = kept.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_anchor"), 1)).alias("anchors"),
                    F.max(peak).alias("peak"), F.max(F.size("v")).alias("len")).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                      "negative_score long")
    if not seen["anchors"]:
        return empty
    top = max(int(seen["peak"]), 1)
    if seen["peak"] < 0 or top * top * seen["len"] * max(100, abs(low), abs(high)) >= 2 ** 63:
        raise OverflowError("inner products of these vectors could exceed 64 bits")
    width = next(w for w in (2, 4, 8) if top < 2 ** (8 * w - 1))
    row_bytes, at_least = 16 + width * seen["len"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = stored(tiles(kept, _parts(seen["n"], row_bytes, TILE_BYTES, at_least), width), f"{name}-tiles")
    blocks = tiles(kept.where("is_anchor"), _parts(seen["anchors"], row_bytes, BLOCK_BYTES, at_least), width)
    blocks = stored(blocks.withColumnRenamed("tile", "block"), f"{name}-blocks")

    shared = _labels_of(blocks, "block").join(_labels_of(packed, "tile"), ["len", "label"]).select("block", "tile").distinct()

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for b in left.to_pylist():
            for t in right.to_pylist():
                if b["len"] == t["len"]:
                    anchors, tile = _opened(b, width), _opened(t, width)
                    found = positive_heaps(anchors, tile, n_positives)
                    n = len(found.row)
                    out.append(pa.table([pa.array(np.full(n, b["block"])), pa.array(np.full(n, b["len"], np.int32)), found.row,
                                         anchors[0][found.row], found.id, found.score], names=columns))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in types], names=columns)

    columns = ["block", "len", "row", "anchor_id", "positive_id", "score"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    found = stored(_met(blocks, packed, shared, positives,
                        "block long, len int, row long, anchor_id long, positive_id long, score long"), f"{name}-positives")
    best = Window.partitionBy("block", "len", "row").orderBy(F.desc("score"), "positive_id")
    chosen = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives)
    # At most n_positives per anchor of a block.
    wanted = chosen.groupBy("block", "len").agg(F.sort_array(F.collect_list(
        F.struct("row", "place", "positive_id", "score"))).alias("wanted"))
    ready = stored(blocks.join(wanted, ["block", "len"]), f"{name}-wanted")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for b in left.to_pylist():
            want = [np.array([w[c] for w in b["wanted"]], np.int64) for c in ("row", "place", "positive_id", "score")]
            for t in right.to_pylist():
                if b["len"] == t["len"]:
                    anchors = _opened(b, width)
                    heaps = window_heaps(anchors, _opened(t, width), want[0], want[3], n_negatives, low, high)
                    j = heaps.row
                    out.append(pa.table([pa.array(np.full(len(j), b["block"])), pa.array(np.full(len(j), b["len"], np.int32)),
                                         want[0][j], want[1][j], anchors[0][want[0][j]], want[2][j], want[3][j], heaps.id,
                                         heaps.score], names=last))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in last_types], names=last)

    last = ["block", "len", "row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    last_types = [pa.int64(), pa.int32(), *[pa.int64()] * 7]
    n_blocks, n_tiles = (df.agg(F.max(c)).first()[0] + 1 for df, c in ((blocks, "block"), (packed, "tile")))
    every = spark.range(n_blocks * n_tiles).select(F.expr(f"id div {n_tiles}").alias("block"), (F.col("id") % n_tiles).alias("tile"))
    near = stored(_met(ready, packed, every, negatives, "block long, len int, row long, place long, anchor_id long, "
                       "positive_id long, positive_score long, negative_id long, negative_score long"), f"{name}-negatives")
    order = Window.partitionBy("block", "len", "row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
