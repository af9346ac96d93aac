"""MinHash near-duplicates by an LSH forest.

A document's set is its distinct word shingles.  Documents with the same set are one class;
everything below works on classes, so groups of exact copies cost no more than one document.

* Signatures: ``TREES`` sorted orders of ``DEPTH`` + ``EXTRA`` minhashes each.  In one order,
  classes that share the first ``DEPTH`` minhashes form a region.
* Candidates: every order is dealt by range over its whole sort key and sorted, so a region of
  any size is spread over tasks.  In a region the neighbours in the order, those with the
  longest common prefix, are candidates, and these stay linear in its size.  The depth is the
  same in every region, ``DEPTH``, and neighbours are ordered by ``EXTRA`` more: a deeper prefix
  in dense regions would lose links.
* Links are confirmed on the full sets, then merged into components.
* What neighbours cannot show: in a region whose classes still lie in different components,
  members of different components are compared by sketches (a byte of every minhash), block by
  block, each pair in the first tree whose region it shares.  A node that looks like a member of another component is then compared with all its
  members on the full sets, block by block again.  So every pair of classes that share a region
  ends up compared or already connected, without a cap, and only confirmed links are written.

A pair of similarity s misses every region with probability (1 - s**DEPTH)**TREES, 5e-9 at
0.8, and the sketch comparison with less than 1e-10.  Sets of fewer than four shingles can at 0.8 only link to equal sets (any other has a
similarity of at most 3/4) and skip the forest.

Texts: null, empty and blank texts have an empty set and link with nothing.  Shingles are
compared by 64-bit hashes.  Rows that agree in id and text are one document, repeated, and get
the same result.  A component's id is its smallest document id; null ids are never smaller
than others, and a component of null ids alone has the null id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, keyed_rows, per_process, stored
from .components import components, extended

SHINGLE_WORDS, SIMILARITY = 5, 80
TREES, DEPTH, EXTRA = 48, 5, 1
#: Rows of a block where members of a region are compared.
BLOCK = 512
#: Words whose hash a worker remembers before it starts over.
WORD_MEMORY = 400_000

_MIX_A, _MIX_B, _MIX_C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), element by element."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_B
    x = (x ^ (x >> np.uint64(27))) * _MIX_C
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word hashes, shingle sets and signatures."""

    def __init__(self, trees: int, depth: int):
        rng = np.random.default_rng(20_240_101)
        n = trees * depth
        self.mul = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.xor = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        self.trees, self.depth = trees, depth
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str | None, width: int) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        import xxhash
        words = text.encode("utf-8").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > WORD_MEMORY:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter((known[w] for w in words), np.uint64, len(words))
        width = min(width, len(h))
        out = np.full(len(h) - width + 1, np.uint64(width))
        for i in range(width):
            out = _mixed(out * _MIX_A + h[i:len(h) - width + 1 + i])
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Minhashes, ``trees`` x ``depth``."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = None
        for at in range(0, len(x), 512):
            part = x[at:at + 512, None] * self.mul[None, :]
            part ^= part >> np.uint32(15)
            part *= np.uint32(0x2C1B3C6D)
            part ^= self.xor[None, :]
            low = part.min(axis=0)
            out = low if out is None else np.minimum(out, low)
        return out.reshape(self.trees, self.depth)


def _hasher(trees: int = TREES, depth: int = DEPTH + EXTRA) -> Hasher:
    return per_process(("minhash", trees, depth), lambda: Hasher(trees, depth))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, least: int) -> DataFrame:
    """``(id, k1, k2, n, node, sig, sketch)``: document key, set size, the set's 128-bit name
    (null if empty), and its region keys.

    ``sig`` holds per tree a 64-bit hash of the first ``DEPTH`` minhashes and the 32 bits of
    the next one, ``sketch`` a byte of every minhash, then four bytes of every tree's hash;
    both are null for sets under ``least`` shingles."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = _hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                n, node, sig, sketch = [], [], [], []
                for text in part.column(3).to_pylist():
                    s = h.shingles(text, width)
                    n.append(len(s))
                    node.append(_digest(s) if len(s) else None)
                    if len(s) < least:
                        sig.append(None)
                        sketch.append(None)
                        continue
                    m = h.signature(s).astype(np.uint64)
                    key = np.zeros(h.trees, np.uint64)
                    for j in range(DEPTH):
                        key = _mixed(key * _MIX_A + m[:, j] + np.uint64(j + 1))
                    row = np.empty(h.trees, dtype=[("key", "<u8"), ("next", "<u4")])
                    row["key"], row["next"] = key, m[:, DEPTH]
                    sig.append(row.tobytes())
                    sketch.append((m & np.uint64(255)).astype(np.uint8).tobytes() + key.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()),
                     pa.array(node, pa.binary()), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())],
                    ["id", "k1", "k2", "n", "node", "sig", "sketch"])

    rows = docs.select(F.col(id_col).alias("id"), *doc_key(id_col, text_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, k1 long, k2 long, n long, node binary, sig binary, sketch binary")


def forest_rows(classes: DataFrame) -> DataFrame:
    """``(tree, key, next, node, n)``: a row per class and tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = np.dtype([("key", "<u8"), ("next", "<u4")])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                count = part.num_rows
                sig = np.frombuffer(b"".join(part.column(2).to_pylist()), row).reshape(count, TREES)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(TREES, dtype=np.int32), count)),
                    pa.array(np.ascontiguousarray(sig["key"]).reshape(-1).view(np.int64)),
                    pa.array(sig["next"].reshape(-1).astype(np.int64)),
                    part.column(0).take(pa.array(np.repeat(np.arange(count), TREES))),
                    pa.array(np.repeat(part.column(1).to_numpy(zero_copy_only=False), TREES))],
                    ["tree", "key", "next", "node", "n"])

    return classes.select("node", "n", "sig").mapInArrow(run, "tree int, key long, next long, node binary, n long")


def neighbours(rows: DataFrame) -> DataFrame:
    """``(tree, key, node, n, prev, prev_n)``: every row with its neighbour before it in the
    order, if both are in one region.

    The rows are dealt by range over the whole order, so a region may go on in the next
    partition: the first and the last row of a partition also come alone (``prev`` null)."""
    order = ["tree", "key", "next", "node"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["tree", "key", "node", "n", "prev", "prev_n"]

    def alone(row: pa.Table) -> pa.RecordBatch:
        none = [pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())]
        return pa.RecordBatch.from_arrays([row[c].combine_chunks() for c in names[:4]] + none, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if last is None:
                yield alone(table.slice(0, 1))
            else:
                table = pa.concat_tables([last, table])
            tree, key = table["tree"].to_numpy(), table["key"].to_numpy()
            at = np.flatnonzero((tree[1:] == tree[:-1]) & (key[1:] == key[:-1]))
            here, before = table.take(pa.array(at + 1)), table.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([here[c].combine_chunks() for c in names[:4]] + [
                before["node"].combine_chunks(), before["n"].combine_chunks()], names)
            last = table.slice(table.num_rows - 1, 1)
        if last is not None:
            yield alone(last)

    return ordered.mapInArrow(run, "tree int, key long, node binary, n long, prev binary, prev_n long")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(node, shingles)`` of the classes in ``wanted (k1, k2)``, each from one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = _hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = [h.shingles(t, width) for t in batch.slice(at, 500).column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    rows = docs.select(*doc_key(id_col, text_col), F.col(text_col).alias("text")).join(
        wanted.hint("merge"), ["k1", "k2"], "left_semi")
    sets = rows.select("text").mapInArrow(run, "node binary, shingles binary")
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"))


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``(a, b)`` with ``100 * intersection >= similarity * union`` on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= similarity * (len(x) + len(y) - shared))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    similarity: int = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: ``id_col, k1, k2, n_shingles, component_id, kept``.

    ``kept`` marks the rows whose id is the component's; several rows may share it."""
    done = _grouped(docs, id_col, text_col, width, similarity)
    return done.select(F.col("id").alias(id_col), "k1", "k2", F.col("n").alias("n_shingles"),
                       "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: int) -> DataFrame:
    """Per row of ``docs``: ``id, k1, k2, n, label, component_id``; the label names the
    component and is null for an empty set."""
    if not 1 <= similarity <= 100 or width < 1:
        raise ValueError("similarity is a percentage, width at least 1")
    name = "lsh-forest"
    # The smallest set that can link to a different one: n / (n + 1) >= similarity.
    least = -(-similarity // (100 - similarity)) if similarity < 100 else 1 << 62
    sigs = stored(signatures(docs, id_col, text_col, width, least), f"{name}-signatures")
    classes = stored(sigs.where("node is not null").groupBy("node").agg(
        F.min("id").alias("low"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("sketch").alias("sketch"),
        F.min(F.struct("k1", "k2")).alias("key")), f"{name}-classes")

    near = stored(neighbours(forest_rows(classes.where("sig is not null"))), f"{name}-neighbours")
    fits = 100 * F.least("n", "prev_n") >= similarity * F.greatest("n", "prev_n")
    pairs = near.where(F.col("prev").isNotNull() & fits).groupBy(
        F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b")).agg(F.min("tree").alias("tree"))
    pairs = stored(pairs.where("a != b"), f"{name}-pairs")
    # ``edge``: the region may go on in another partition, so its neighbours are not all known.
    region = near.select("tree", "key", "node", "n", F.col("prev").isNull().alias("edge")).unionByName(
        near.where("prev is not null").select("tree", "key", F.col("prev").alias("node"), F.col("prev_n").alias("n"),
                                              F.lit(False).alias("edge")))
    region = stored(region.groupBy("tree", "key", "node").agg(F.first("n").alias("n"), F.max("edge").alias("edge")),
                    f"{name}-regions")
    members = region.select("node").distinct()
    wanted = classes.join(members, "node", "left_semi").select("key.k1", "key.k2")
    sets = stored(full_sets(docs, wanted, id_col, text_col, width), f"{name}-sets")

    # Neighbours in the first orders, then those of all orders that are not yet connected,
    # then whatever else shares a region and is not.
    first = pairs.where("tree < 4").select("a", "b")
    labels = components(stored(confirmed(first, sets, similarity), f"{name}-links1"), f"{name}-components1")
    apart = _apart(pairs.where("tree >= 4").select("a", "b"), labels)
    labels = extended(labels, stored(confirmed(apart, sets, similarity), f"{name}-links2"), f"{name}-components2")
    found = stored(lookalikes(region, labels, classes, similarity), f"{name}-lookalikes")
    links = stored(component_links(found, labels, sets, similarity), f"{name}-links3")
    labels = extended(labels, links, f"{name}-components3")

    group = classes.select("node", "low").join(labels, "node", "left").select(
        "node", "low", F.coalesce("label", "node").alias("label"))
    lowest = stored(group.groupBy("label").agg(F.min("low").alias("component_id")), f"{name}-lowest")
    group = stored(group.join(lowest, "label").select("node", "label", "component_id"), f"{name}-groups")
    done = sigs.select("id", "k1", "k2", "n", "node").join(group, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select("id", "k1", "k2", "n", "label", component.alias("component_id"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends do not have the same label."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    rows = pairs.join(left, "a", "left").join(right, "b", "left")
    return rows.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def least_agreement(similarity: int) -> int:
    """Minhashes that a pair of this similarity agrees in, but for a chance under 1e-10."""
    count, share = TREES * (DEPTH + EXTRA), similarity / 100
    return int(count * share - 6.5 * (count * share * (1 - share))**0.5)


def lookalikes(region: DataFrame, labels: DataFrame, classes: DataFrame, similarity: int,
                 block: int = BLOCK) -> DataFrame:
    """Distinct ``(label, node)``: a component and a node outside it that share a region where
    the node looks like a member: their sizes allow the similarity and their sketches agree as
    often as it asks for.

    Regions whose neighbours were all compared are done, and members of one component never
    meet.  Two nodes are compared in the first tree whose region they share: a linked pair of two
    components has only open regions, so none is lost.  (Regions pass as equal if four bytes of
    their hashes and the bytes of their minhashes are: wrongly with a chance under 1e-10 a pair.)
    The largest component of a region is its core; core and rest are dealt into blocks
    by a hash, and a task compares a block of the core with a block of the rest, or two blocks
    of the rest, so neither a region nor a component is gathered in one task."""
    name = "lsh-forest"
    rows = stored(region.join(labels, "node", "left").select(
        "tree", "key", "node", "n", "edge", F.coalesce("label", "node").alias("label")), f"{name}-labelled")
    parts = rows.groupBy("tree", "key", "label").agg(F.count(F.lit(1)).alias("c"), F.max("edge").alias("edge"))
    regions = parts.groupBy("tree", "key").agg(
        F.max_by("label", F.struct("c", "label")).alias("core"), F.max("c").alias("in_core"), F.sum("c").alias("size"),
        F.count(F.lit(1)).alias("parts"), F.max("edge").alias("edge"))
    open_ones = regions.where((F.col("parts") > 1) & ((F.col("size") > 2) | F.col("edge"))).select(
        "tree", "key", "core", F.ceil(F.col("in_core") / block).cast("long").alias("core_blocks"),
        F.ceil((F.col("size") - F.col("in_core")) / block).cast("long").alias("rest_blocks"))
    open_ones = stored(open_ones, f"{name}-open")
    rows = rows.select("tree", "key", "node", "n", "label").join(open_ones, ["tree", "key"])
    spread = F.xxhash64("node")

    def spots(start, stop, make):
        return F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(stop, F.lit(1)) - 1), lambda j: j >= start), make)

    def spot(kind, x, y, side):
        return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), F.lit(side).alias("side"))

    own = F.when(F.col("label") == F.col("core"), F.pmod(spread, "core_blocks")).otherwise(F.pmod(spread, "rest_blocks"))
    rows = rows.withColumn("own", own)
    mine, zero = F.col("own"), F.lit(0).cast("long")
    core = spots(zero, F.col("rest_blocks"), lambda j: spot(0, mine, j, 0))
    rest = F.concat(spots(zero, F.col("core_blocks"), lambda i: spot(0, i, mine, 1)),
                    spots(mine + 1, F.col("rest_blocks"), lambda j: spot(1, mine, j, 0)),
                    F.filter(spots(zero, F.col("rest_blocks"), lambda j: spot(1, j, mine, 1)), lambda t: t["x"] < t["y"]))
    placed = rows.withColumn("spot", F.explode(F.when(F.col("label") == F.col("core"), core).otherwise(rest)))
    sketches = classes.where("sketch is not null").select("node", "sketch")
    group = ["tree", "key", "kind", "x", "y"]
    placed = placed.select("tree", "key", "spot.kind", "spot.x", "spot.y", "spot.side", "node", "n", "label").join(
        sketches, "node").select(*group, "side", "node", "n", "label", "sketch")
    least, count = least_agreement(similarity), TREES * (DEPTH + EXTRA)

    def compared(t: pa.Table) -> list[tuple[bytes, bytes]]:
        """What looks alike in one group: side 0 with side 1, and side 1 with itself where its
        block meets the first block of the core.  A node is named once per component."""
        node, names = t["node"].to_pylist(), t["label"].to_pylist()
        names, label = np.unique(names, return_inverse=True)
        n, side = t["n"].to_numpy(), t["side"].to_numpy()
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)
        sketch, key = sketch[:, :count], sketch[:, count:].copy().view("<u4")
        low, tree = sketch.reshape(len(node), TREES, -1)[:, :, :DEPTH], t["tree"][0].as_py()
        itself = t["kind"][0].as_py() == 0 and t["x"][0].as_py() == 0
        first, out = np.flatnonzero(side == 0), []
        for i in np.flatnonzero(side == 1):
            to = np.concatenate([first, np.flatnonzero((side == 1) & (np.arange(len(side)) > i))]) if itself else first
            to = to[(label[to] != label[i]) & (100 * np.minimum(n[to], n[i]) >= similarity * np.maximum(n[to], n[i]))]
            if len(to):
                alike = to[(sketch[to] == sketch[i]).sum(axis=1) >= least]
                met = (key[alike, :tree] == key[i, :tree]) & (low[alike, :tree] == low[i, :tree]).all(axis=2)
                alike = alike[~met.any(axis=1)]
                out.extend((names[k], node[i]) for k in np.unique(label[alike]))
        return out

    dealt = placed.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_by_group(group, compared, ["label", "node"]), "label binary, node binary").distinct()


def component_links(found: DataFrame, labels: DataFrame, sets: DataFrame, similarity: int,
                    block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between each component and the outside nodes found to look like a member:
    every member is compared with them on the full sets, and of a node's links to a block of
    members one is returned.

    Members and outsiders of a component are dealt into blocks by a hash; a task compares two
    blocks, each set is sent once per block it meets, and no pair is written before it is
    confirmed."""
    name = "lsh-forest"
    every = found.select("label").distinct()
    single = every.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(
        "label", F.col("label").alias("node"))
    member = every.join(labels.select("label", "node"), "label").unionByName(single)
    both = member.withColumn("side", F.lit(0)).unionByName(found.select("label", "node").withColumn("side", F.lit(1)))
    both = stored(both, f"{name}-compare")
    counts = both.groupBy("label").agg(
        F.ceil(F.count(F.when(F.col("side") == 0, 1)) / block).cast("long").alias("x_blocks"),
        F.ceil(F.count(F.when(F.col("side") == 1, 1)) / block).cast("long").alias("y_blocks"))
    rows = both.join(stored(counts, f"{name}-blocks"), "label")
    spread = F.xxhash64("node")

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    x = F.when(F.col("side") == 0, F.array(F.pmod(spread, "x_blocks"))).otherwise(upto("x_blocks"))
    rows = rows.select("label", "node", "side", "y_blocks", F.explode(x).alias("x"))
    y = F.when(F.col("side") == 1, F.array(F.pmod(spread, "y_blocks"))).otherwise(upto("y_blocks"))
    group = ["label", "x", "y"]
    rows = rows.select("label", "node", "side", "x", F.explode(y).alias("y")).join(sets, "node").select(
        *group, "side", "node", "shingles")

    def compared(t: pa.Table) -> list[tuple[bytes, bytes]]:
        node, side = t["node"].to_pylist(), t["side"].to_numpy()
        held = [np.frombuffer(v, np.uint64) for v in t["shingles"].to_pylist()]
        inside = np.flatnonzero(side == 0)
        if not len(inside):
            return []
        flat = np.concatenate([held[i] for i in inside])
        size = np.array([len(held[i]) for i in inside])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        out = []
        for i in np.flatnonzero(side == 1):
            at = np.searchsorted(held[i], flat)
            at[at == len(held[i])] = 0
            shared = np.add.reduceat((held[i][at] == flat).astype(np.int64), start)
            linked = np.flatnonzero(100 * shared >= similarity * (size + len(held[i]) - shared))
            if len(linked):
                out.append((node[inside[linked[0]]], node[i]))
        return out

    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_by_group(group, compared, ["a", "b"]), "a binary, b binary")


def _by_group(group: list[str], compared, names: list[str]):
    """A batch function that hands ``compared`` the rows of one group at a time, of batches
    sorted by the group's columns."""

    def emit(out):
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.binary()) for i in (0, 1)], names)

    def changes(column) -> np.ndarray:
        from pyarrow import compute
        column = column.combine_chunks()
        return compute.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            new = np.flatnonzero(np.any([changes(table[c]) for c in group], axis=0)) + 1
            starts = [0, *new.tolist()]
            out = [p for a, b in zip(starts[:-1], starts[1:], strict=True) for p in compared(table.slice(a, b - a))]
            held = table.slice(starts[-1])
            yield emit(out)
        if held is not None:
            yield emit(compared(held))

    return run


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                         similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one document of every group, that of the smallest id, null ids last, and
    among texts of one id that of the smallest text hash; every column stays.  Documents with
    an empty set are no group and stay.

    Rows that repeat the id and text of a kept document are reduced to one as well."""
    found = stored(_grouped(docs, id_col, text_col, width, similarity), "lsh-forest-grouped")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k2", "k1")).alias("m")
    first = found.where("label is not null").groupBy("label").agg(best).select("m.k1", "m.k2")
    kept = first.unionByName(found.where("label is null").select("k1", "k2").distinct())
    kept = stored(kept.select("k1", "k2"), "lsh-forest-kept")
    rows = keyed_rows(docs, id_col, text_col).join(kept.hint("merge"), ["k1", "k2"], "left_semi")
    return rows.dropDuplicates(["k1", "k2"]).select("row.*")
