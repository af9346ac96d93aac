"""The prefix trie of conversations, from sorted paths, their common prefixes and range minima.

A conversation is a path: the 128-bit digests of its turns (role and text), 16 bytes each, in
order.  Sorted by their bytes, all paths with the same first d turns are neighbours, and the
common-prefix lengths (LCPs) between neighbours there are at least d.  So a node of the trie is
an interval of the sorted paths: a candidate prefix (a path and a depth) finds its ends by
binary search to the left and to the right, each on its own, in a sparse table of range minima
over the LCPs, without any stack.  Counts and sums over a node's members or subtree are then
differences of running sums.

On a cluster:

* Equal paths are one path.  Their conversations (which may be a third of all) are dealt by
  ranges of (path digest, conversation id), so a large group is spread over many tasks; each
  task lists its ids in blocks of ``LIST_IDS``, and the blocks are joined as a stream.
* Distinct paths are dealt by range into blocks of about ``BLOCK_BYTES``.  Every block finds the
  nodes that begin and end in it.  A node that crosses an end of its block (a prefix shared by
  the neighbours there) leaves a piece per block; the pieces, a few per block and far fewer than
  the paths, are put together in one task by running sums in the order of their first places.

Texts never travel with a path.  A conversation is one row: 28 bytes a turn or so, which has
to fit a task's memory, as a document's text has to.

Rows: a null ``role`` or ``text`` is empty; a null ``turn`` comes first; turns of one number are
ordered by their digests, and a repeated row is a turn of its own.  Rows without a ``conv_id``
belong to no conversation and take no part.  Other columns are not read.  An empty table has
no node; otherwise the root has depth 0, no text and every conversation as a member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bytes of paths, and paths, in one block of the sorted order, about.
BLOCK_BYTES = 8_000_000
BLOCK_PATHS = 200_000
#: Conversation ids listed in one row at most.
LIST_IDS = 20_000
DIGEST = 16
# Fixed value: the words that are counted.
WORD = r"[^\x20\x09-\x0D]+"

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --------------------------------------------------------------------------- conversations

def paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: every conversation's turns ``array<struct<turn, digest, words>>``
    in order.  A digest covers the role's length, the role and the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"),
                 F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(convs: DataFrame, base: Column, n_head: Column, max_head: int) -> DataFrame:
    """Every conversation with its first ``n_head`` turns (``max_head`` at most) replaced by those
    of conversation ``base``: by fewer if that one has fewer, by none if there is none."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, max_head).alias("head"))
    rows = convs.withColumns({"base": base.cast("long"), "h": n_head.cast("int")})
    # Merged at every size: both sides grow with the conversations.
    both = rows.join(heads.hint("merge"), "base", "left")
    empty = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", empty), F.lit(1), F.col("h"))
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).otherwise(empty)
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def shared_heads(convs: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Conversation c with its first ``crc32(c) % heads`` turns taken from ``c - c % every``."""
    c = F.col("conv_id")
    return rebuilt(convs, c - c % every, F.crc32(c.cast("string")) % heads, heads - 1)


# --------------------------------------------------------------------------- equal paths

def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a digest in sorted ``(digest, conv_id)`` as rows of at most ``LIST_IDS`` ids."""
    digest, ids, out = None, [], []

    def close():
        if ids:
            out.append((digest, ids[0], len(ids), ",".join(map(str, ids))))

    def batch():
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.string())], ["digest", "first", "n", "ids"])

    for rows in batches:
        for d, c in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            if d != digest or len(ids) >= LIST_IDS:
                close()
                digest, ids = d, []
            ids.append(c)
        yield batch()
        out.clear()
    close()
    yield batch()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest from its blocks in order: smallest id, count, SHA-256 of the list."""
    digest, first, n, sha = None, None, 0, None
    out = []

    def batch():
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
            ["conv_id", "n", "ends"])

    for rows in batches:
        for d, f, k, ids in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
            if d != digest:
                if digest is not None:
                    out.append((first, n, sha.hexdigest()))
                digest, first, n, sha = d, f, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
            n += k
        yield batch()
        out.clear()
    if digest is not None:
        out.append((first, n, sha.hexdigest()))
    yield batch()


def equal_paths(convs: DataFrame) -> DataFrame:
    """``(conv_id, n, ends)`` per distinct path of ``(conv_id, digest)``: the smallest
    conversation of that path, their number, and the SHA-256 of their ids, sorted and joined."""
    dealt = convs.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    blocks = dealt.mapInArrow(_listed, "digest binary, first long, n long, ids string")
    blocks = blocks.repartition("digest").sortWithinPartitions("digest", "first")
    return blocks.mapInArrow(_hashed, "conv_id long, n long, ends string")


# --------------------------------------------------------------------------- range minima

class RangeMinima:
    """Minima of ranges of an integer array, by a sparse table of power-of-two windows."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values)]
        width = 1
        while 2 * width <= len(values):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def query(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of ``values[start:end]`` (not empty)."""
        level = np.frexp((end - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - (1 << int(k))])
        return out

    def right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The largest ends with all of ``values[start:end]`` at least ``bound`` (binary search
        over the windows' widths)."""
        end = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            if not len(table):
                continue
            inside = end < len(table)
            go = inside & (table[np.where(inside, end, 0)] >= bound)
            end = np.where(go, end + (1 << k), end)
        return end

    def left(self, end: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest starts with all of ``values[start:end]`` at least ``bound``."""
        start = end.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, width = self.levels[k], 1 << k
            if not len(table):
                continue
            inside = start >= width
            go = inside & (table[np.where(inside, start - width, 0)] >= bound)
            start = np.where(go, start - width, start)
        return start


def common_prefixes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """LCPs (in turns) of neighbours among paths ``data[offsets[i]:offsets[i + 1]]``, where
    ``data`` has one row of two 64-bit words per turn."""
    size = np.diff(offsets)
    lcp = np.zeros(max(len(size) - 1, 0), np.int64)
    live, depth = np.arange(len(lcp)), 0
    while len(live):
        live = live[np.minimum(size[live], size[live + 1]) > depth]
        same = (data[offsets[live] + depth] == data[offsets[live + 1] + depth]).all(axis=1)
        live = live[same]
        lcp[live] += 1
        depth += 1
    return lcp


# --------------------------------------------------------------------------- one block

# A node that lies in one block, or a piece of one that crosses an end of it (``piece``).
# ``opens``: the node begins in this block.  ``parent_piece``: the parent is a piece of the block
# (of that ``opens``) and its conversation is not known here.
_PART = ("block long, piece boolean, opens boolean, runs_on boolean, depth long, conv_id long, parent_conv_id long, "
         "parent_piece boolean, parent_opens boolean, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "words long, ends string")
_PART_TYPES = [pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(),
               pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_PART_NAMES = [c.split(" ")[0] for c in _PART.split(", ")]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a binary or list column."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    if pa.types.is_list(array.type):
        return array.values.to_numpy(zero_copy_only=False), np.asarray(array.offsets, np.int64)
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int32, len(array) + 1, array.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[:ends[-1]], ends


def block_nodes(table: pa.Table) -> pa.Table:
    """The nodes and pieces of one block.

    Rows, in any order: ``block, side, path, words, conv_id, n, ends``; ``side`` is 0 for the
    paths of the block, -1 and 1 for the last path before it and the first one after it.
    """
    table = table.sort_by([("side", "ascending"), ("path", "ascending")])
    side = table["side"].to_numpy()
    data, ends_at = _flat(table["path"])
    offsets = ends_at // DIGEST
    lcp = common_prefixes(data.view(np.uint64).reshape(-1, 2), offsets)
    # LCPs with the neighbours, one more than there are paths; -1 where there is no neighbour.
    if side[0] == 0:
        lcp = np.concatenate([[-1], lcp])
    if side[-1] == 0:
        lcp = np.concatenate([lcp, [-1]])
    own = np.flatnonzero(side == 0)
    table = table.take(pa.array(own))
    m = len(own)
    size = np.diff(offsets)[own]
    first, last = lcp[0], lcp[-1]
    words, word_at = _flat(table["words"])
    conv = table["conv_id"].to_numpy()
    ends = np.array(table["ends"].to_pylist(), object)

    # Candidates: every path with every depth, in order; the root's depth 0 first.
    base = np.concatenate([[0], np.cumsum(size + 1)])
    at = np.repeat(np.arange(m), size + 1)
    depth = np.arange(base[-1]) - base[at]
    minima = RangeMinima(lcp[1:m]) if m > 1 else RangeMinima(np.empty(0, np.int64))
    left = minima.left(at, depth)
    right = minima.right(at, depth)          # the last path of the interval
    keep = np.flatnonzero(left == at)        # one candidate per node: that of its first path
    depth, start, end = depth[keep], at[keep], right[keep] + 1
    parent_at = np.where(depth > 0, base[left[np.maximum(keep - 1, 0)]] + depth - 1, -1)
    place = np.full(base[-1], -1)
    place[keep] = np.arange(len(keep))
    parent = np.where(parent_at >= 0, place[parent_at], -1)

    opens = ~((start == 0) & (depth <= first))
    runs_on = (end == m) & (depth <= last)
    piece = ~opens | runs_on
    count = np.concatenate([[0], np.cumsum(table["n"].to_numpy())])
    is_leaf = lcp[1:] < size
    leaves = np.concatenate([[0], np.cumsum(is_leaf)])
    n = count[end] - count[start]
    children = np.bincount(parent[opens & (parent >= 0)], minlength=len(keep))
    w = np.where(depth > 0, words[np.where(depth > 0, word_at[start] + depth - 1, 0)] if len(words) else 0, 0).astype(np.int64)
    saved = np.concatenate([[0], np.cumsum(np.where(piece, 0, (n - 1) * w))])
    # Nodes stand in the order of (first path, depth): a subtree is a stretch of them.
    node_start = np.searchsorted(start, np.arange(m + 1))
    subtree = saved[node_start[end]] - saved[np.arange(len(keep))]
    known = (parent >= 0) & ~piece[parent]
    members = RangeMinima(conv).query(start, end)
    closed = np.where(size[start] == depth, ends[start], None)
    block = table["block"][0].as_py()
    some = parent >= 0
    columns = [
        np.full(len(keep), block), piece, opens, runs_on, depth, members,
        pa.array(np.where(known, members[parent], 0), mask=~known), ~known & some, some & opens[parent],
        n, children, leaves[end] - leaves[start], subtree, w, pa.array(closed, pa.string())]
    return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                 for c, t in zip(columns, _PART_TYPES, strict=True)], _PART_NAMES)


# --------------------------------------------------------------------------- nodes over several blocks

_JOINED = ("block long, depth long, opens boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, ends string")


def join_pieces(table: pa.Table) -> pa.Table:
    """The nodes that cross ends of blocks, from their pieces: one row per piece, with the whole
    node's values.  The pieces of a node are those of its depth from the one that opens it to
    the next that opens."""
    table = table.sort_by([("depth", "ascending"), ("block", "ascending"), ("opens", "ascending")])
    col = {c: table[c].to_numpy(zero_copy_only=False) for c in
           ("block", "depth", "opens", "runs_on", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")}
    opens = col["opens"].astype(bool)
    head = np.flatnonzero(opens)
    node = np.cumsum(opens) - 1
    total = {c: np.add.reduceat(col[c], head) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    conv = np.minimum.reduceat(col["conv_id"], head)
    block, depth = col["block"][head], col["depth"][head]
    last = np.maximum.reduceat(col["block"], head)
    # Nodes by the place they open at; the nodes below one are those that open after it and
    # before its last block (what opens there and runs on lies behind its end).
    order = np.lexsort((depth, block))
    value = ((total["n_convs"] - 1) * col["words"][head])[order]
    running = np.concatenate([[0], np.cumsum(value)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    saved = total["saved_tokens"] + running[np.searchsorted(block[order], last)] - running[rank]
    # The parent: the piece one turn shorter that runs on from the same block.
    runs = np.flatnonzero(col["runs_on"].astype(bool))
    of_run = {(int(b), int(d)): int(node[i]) for b, d, i in zip(col["block"][runs], col["depth"][runs], runs, strict=True)}
    parent = np.array([of_run[int(b), int(d) - 1] if d > 0 else -1 for b, d in zip(block, depth, strict=True)], np.int64)
    parent_conv = pa.array(np.where(parent >= 0, conv[parent], 0)[node], mask=(parent < 0)[node])
    ends = pa.array([table["ends"][int(i)].as_py() for i in head], pa.string()).take(pa.array(node))
    return pa.Table.from_arrays(
        [pa.array(col["block"]), pa.array(col["depth"]), pa.array(opens), pa.array(conv[node]), parent_conv,
         pa.array(total["n_convs"][node]), pa.array(total["n_children"][node]), pa.array(total["n_leaves"][node]),
         pa.array(saved[node]), ends],
        ["block", "depth", "opens", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"])


# --------------------------------------------------------------------------- the trie

def sorted_blocks(distinct: DataFrame, block_bytes: int, block_paths: int) -> DataFrame:
    """Distinct paths dealt into blocks of the sorted order, with the neighbours of each block."""
    sizes = distinct.agg(F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    parts = max(1, -(-sizes["bytes"] // block_bytes), -(-sizes["n"] // block_paths))
    dealt = distinct.repartitionByRange(int(parts), "path").withColumn("block", F.spark_partition_id().cast("long"))
    dealt = stored(dealt.withColumn("side", F.lit(0)), "trie-blocks")
    # Two rows per block, whatever its size.
    edges = dealt.groupBy("block").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    edges = stored(edges.withColumn("at", F.row_number().over(Window.orderBy("block"))), "trie-edges")
    before = edges.select((F.col("at") + 1).alias("at"), F.lit(-1).alias("side"), F.col("high").alias("path"))
    after = edges.select((F.col("at") - 1).alias("at"), F.lit(1).alias("side"), F.col("low").alias("path"))
    near = edges.select("at", "block").join(before.unionByName(after), "at").select("block", "side", "path")
    return dealt.unionByName(near, allowMissingColumns=True)


def prefix_trie(convs: DataFrame, block_bytes: int = BLOCK_BYTES, block_paths: int = BLOCK_PATHS) -> DataFrame:
    """One row per node of the trie of ``(conv_id, turns)`` (see ``paths``), as ``NODE_COLUMNS``:

    ``conv_id`` the smallest member; ``depth``; ``parent_conv_id`` the parent's (null at the
    root); ``n_convs`` members; ``n_children``; ``n_leaves`` childless nodes of the subtree,
    itself included; ``saved_tokens`` over the subtree, each node's ``n_convs - 1`` times the
    words of its last turn; ``ends_sha256`` of the members that end at the node.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    convs = stored(convs.select("conv_id", path.alias("path"), F.unhex(F.md5(path)).alias("digest"),
                                F.transform("turns", lambda t: t["words"]).alias("words")), "trie-paths")
    groups = stored(equal_paths(convs), "trie-groups")
    distinct = stored(groups.join(convs.drop("digest").hint("merge"), "conv_id"), "trie-distinct")
    rows = sorted_blocks(distinct, block_bytes, block_paths)
    parts = stored(rows.select("block", "side", "path", "words", "conv_id", "n", "ends").groupBy("block")
                   .applyInArrow(block_nodes, _PART), "trie-parts")
    joined = stored(parts.where("piece").groupBy("piece").applyInArrow(join_pieces, _JOINED), "trie-joined")
    inside = parts.where("NOT piece")
    outer = joined.select("block", (F.col("depth") + 1).alias("depth"), F.col("opens").alias("parent_opens"),
                          F.col("conv_id").alias("outer"))
    inside = inside.join(outer, ["block", "depth", "parent_opens"], "left").withColumn(
        "parent_conv_id", F.when(F.col("parent_piece"), F.col("outer")).otherwise(F.col("parent_conv_id")))
    nodes = inside.select(*NODE_COLUMNS[:-1], "ends").unionByName(joined.where("opens").select(*NODE_COLUMNS[:-1], "ends"))
    return nodes.select(*NODE_COLUMNS[:-1], F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
