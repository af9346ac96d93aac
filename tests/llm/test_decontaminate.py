import hashlib
import random
import re

from pyspark.sql import functions as F

from tradelens.llm import decontaminate as DC
from tradelens.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def toks(t):
    return [] if t is None else WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))


def brute(docs, items, w=13):
    out = []
    for i, t in docs:
        d = toks(t)
        hit, met = set(), set()
        for item, it in items:
            x = toks(it)
            n = min(w, len(x))
            wins = {tuple(x[j:j + n]) for j in range(len(x) - n + 1)} if n else set()
            for j in range(len(d) - n + 1):
                if n and tuple(d[j:j + n]) in wins:
                    hit |= set(range(j, j + n))
                    met.add(str(item))
        out.append((i, len(d), len(hit), len(met),
                    hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(d)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in Q.contamination(d, b).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    return sorted(got, key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocab = ["The", "of", "a", "ÉTÉ", "x1", "dog", "cat", "İx", "run"]
    say = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "--", "\n"]) for _ in range(n))
    items = [(i, say(rng.choice([14, 20, 33]))) for i in range(8)]
    items += [(20, "tiny"), (21, "a b c d e f g"), (22, None), (23, ""), (24, items[0][1]), (25, say(12)), (26, "...")]
    docs = []
    for i in range(50):
        t = say(rng.randint(0, 60))
        if rng.random() < 0.6:
            x = items[rng.randrange(len(items))][1] or ""
            ws = x.split()
            a = rng.randint(0, max(0, len(ws) - 13))
            t += " . " + " ".join(ws[a:a + rng.choice([7, 12, 13, 15, 40])]).upper() + " " + say(rng.randint(0, 9))
        docs.append((i, t))
    docs += [(70, None), (71, ""), (72, "the"), (None, items[1][1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_no_short_items_and_repeated_rows(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "x " * 400 + item), (2, "w1 w2 w3"), (3, item.replace(" ", ", ").upper()), (3, item)]
    items = [(5, item), (5, item), (10, item)]
    assert run(spark, docs, items) == brute(docs, sorted(set(items)))


def test_empty_tables_and_removal(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, " ".join("abcdefghijklmnop"))], "doc_id long, text string")
    assert DC.overlaps(empty, none).count() == 0
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])
    items = spark.createDataFrame([(1, " ".join("abcdefghijklmnop"))], "item_id long, text string")
    assert [r[0] for r in DC.remove_contaminated(docs, items).select(F.col("doc_id")).collect()] == [1, 1]
