import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from tradelens.llm import prefix_trie as T
from tradelens.llm import queries as Q


def brute(convs):
    """Node rows of ``{conv_id: [(turn key, words), ...]}``."""
    members, words = defaultdict(list), {(): 0}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            key = tuple(t for t, _ in turns[:d])
            members[key].append(c)
            if d:
                words[key] = turns[d - 1][1]
    kids = defaultdict(int)
    for key in members:
        if key:
            kids[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in members:
        for d in range(len(key) + 1):
            leaves[key[:d]] += not kids[key]
            saved[key[:d]] += (len(members[key]) - 1) * words[key]
    rows = []
    for key, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(key))
        rows.append((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), kids[key], leaves[key], saved[key],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def _digest(x):
    return hashlib.md5(str(x).encode()).digest()


def _by_blocks(convs, cuts):
    """The trie through ``block_nodes`` and ``join_pieces``, without Spark."""
    groups = defaultdict(list)
    for c, turns in convs.items():
        groups[b"".join(_digest(t) for t, _ in turns)].append(c)
    order = sorted(groups)
    rows = []
    for path in order:
        cs = sorted(groups[path])
        ends = hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
        rows.append({"path": path, "words": [w for _, w in convs[cs[0]]], "conv_id": cs[0], "n": len(cs), "ends": ends})
    schema = pa.schema([("block", pa.int64()), ("side", pa.int32()), ("path", pa.binary()), ("words", pa.list_(pa.int32())),
                        ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    bounds = sorted({0, len(rows), *(x for x in cuts if x < len(rows))})
    parts = []
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        some = [{**r, "block": b, "side": 0} for r in rows[lo:hi]]
        some += [{"block": b, "side": -1, "path": rows[lo - 1]["path"]}] if lo else []
        some += [{"block": b, "side": 1, "path": rows[hi]["path"]}] if hi < len(rows) else []
        random.shuffle(some)
        parts += T.block_nodes(pa.Table.from_pylist(some, schema)).to_pylist()
    pieces = [p for p in parts if p["piece"]]
    joined = []
    if pieces:
        names, types = T._PART_NAMES, T._PART_TYPES
        joined = T.join_pieces(pa.Table.from_pylist(pieces, pa.schema(list(zip(names, types))))).to_pylist()
    outer = {(j["block"], j["depth"], j["opens"]): j["conv_id"] for j in joined}
    out = []
    for p in [*(p for p in parts if not p["piece"]), *(j for j in joined if j["opens"])]:
        parent = outer[p["block"], p["depth"] - 1, p["parent_opens"]] if p.get("parent_piece") else p["parent_conv_id"]
        out.append((p["conv_id"], p["depth"], parent, p["n_convs"], p["n_children"], p["n_leaves"], p["saved_tokens"],
                    p["ends"] or T.EMPTY_SHA256))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(60))
def test_blocks_give_the_whole_trie(seed):
    random.seed(seed)
    convs = {c: [(t, t + 1) for t in random.choices(range(random.choice([1, 2, 4])), k=random.randint(0, random.choice([2, 5, 12])))]
             for c in random.sample(range(1000), random.randint(1, 40))}
    for cuts in ([], range(1, 50), random.sample(range(1, 50), 4), [1], [5]):
        assert _by_blocks(convs, cuts) == brute(convs)


def test_range_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 37):
        values = rng.integers(0, 5, n)
        m = T.RangeMinima(values)
        start, end = np.array([(s, e) for s in range(n) for e in range(s + 1, n + 1)]).T
        assert m.query(start, end).tolist() == [values[s:e].min() for s, e in zip(start, end)]
        at, bound = np.array([(p, b) for p in range(n + 1) for b in range(6)]).T
        assert m.right(at, bound).tolist() == [max(e for e in range(p, n + 1) if (values[p:e] >= b).all()) for p, b in zip(at, bound)]
        assert m.left(at, bound).tolist() == [min(s for s in range(p + 1) if (values[s:p] >= b).all()) for p, b in zip(at, bound)]


def _rebuilt(rows):
    """``{conv_id: [(turn key, words), ...]}`` of ``(conv_id, turn, role, text)``, rebuilt."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[c].append((turn is not None, turn or 0, key, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    by = {c: [(k, w) for _, _, k, w in sorted(ts)] for c, ts in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = by.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    return out


def _rows(df):
    return sorted([tuple(r) for r in df.select(*T.NODE_COLUMNS).collect()], key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [(1, 0, "user", "a b"), (1, 1, None, "c"), (1, 1, "bot", "c"), (1, None, "user", None), (1, 0, "user", "a b"),
            (20, 0, "user", "x"), (20, 1, "bot", "y z"), (21, 3, "user", ""), (21, 4, "bot", "q"), (22, 0, "user", "x"),
            (None, 0, "user", "a"), (None, None, None, None), (-3, 0, "a", "bc"), (-4, 0, "ab", "c")]
    rows += [(c, i, "user", f"turn {i}") for c in (40, 43, 45) for i in range(300)]
    rows += [(c, 0, "user", "same") for c in range(100, 160)]
    want = brute(_rebuilt(rows))
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA + ", path string").withColumnRenamed("path", "words")
    for size in (T.BLOCK_PATHS, 2):
        assert _rows(T.prefix_trie(T.shared_heads(T.paths(df)), block_paths=size)) == want
    assert T.prefix_trie(T.shared_heads(T.paths(df.limit(0)))).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert _rows(Q.q_prefix_trie(spark, SF_SMALL)) == brute(_rebuilt(rows))


def test_long_lists_of_conversations_are_joined_from_blocks(spark, monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"digest": [b"a"] * 5 + [b"b"] * 2, "conv_id": [1, 2, 3, 10, 11, 4, 5]}),
               pa.RecordBatch.from_pydict({"digest": [b"b"], "conv_id": [60]})]
    monkeypatch.setattr(T, "LIST_IDS", 2)
    lists = list(T._listed(iter(batches)))
    assert max(r["n"] for b in lists for r in b.to_pylist()) == 2
    got = [tuple(r.values()) for b in T._hashed(iter(lists)) for r in b.to_pylist()]
    assert got == [(1, 5, hashlib.sha256(b"1,2,3,10,11").hexdigest()), (4, 3, hashlib.sha256(b"4,5,60").hexdigest())]
