import random

from tradelens.llm import lsh_forest as LF
from tradelens.llm.components import components, extended


def brute(rows, width, similarity):
    sets = []
    for _, t in rows:
        w = [] if t is None else t.encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= similarity * (len(sets[i]) + len(sets[j]) - n):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids, default=None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.55:
            w = (rng.choice(texts) or "a").split()
            for _ in range(rng.randint(0, 1 + len(w) // 12)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
        else:
            texts.append(" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 40, 120]))))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(500, None), (501, " \t"), (None, texts[5]), (3, texts[3]), (None, "solo words here now ok")]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    got = LF.near_duplicates(df, **options).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_against_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows, width=2) == brute(rows, 2, 80)


def test_five_word_default_and_kept_rows(spark):
    rows = corpus(2, 80)
    assert run(spark, rows) == brute(rows, 5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id for r in LF.drop_near_duplicates(df).collect()), key=str)
    assert kept == sorted({r[0] for r in brute(rows, 5, 80) if r[3]}, key=str)


def test_one_document_of_a_group_stays_for_null_and_shared_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a), (None, a + " z"), (None, a + " z"), (7, b), (7, b + " z"), (8, b + " y"), (7, c), (None, c + " z"),
            (None, ""), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, (r.text or "")[:1]) for r in LF.drop_near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(None, "a"), (7, "b"), (7, "c"), (None, ""), (9, "")], key=str)


def test_empty_table(spark):
    assert run(spark, [], width=2) == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (300, 299), (299, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(60))
    assert got[300] == 299 and components(df.limit(0)).count() == 0


def test_more_links_extend_the_labels(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "a long, b long")
    labels = components(frame([(1, 2), (2, 3), (10, 11), (20, 21)]))
    assert extended(labels, frame([])).count() == 7
    got = {r.node: r.label for r in extended(labels, frame([(3, 11), (30, 31), (21, 20), (11, 40)])).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 40: 1, 20: 20, 21: 20, 30: 30, 31: 30}


def test_blocks_of_a_region_lose_no_pair(spark, monkeypatch):
    """A star: copies are linked to their base only, among them and to heavier edits not."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 70):
        w = list(base)
        for k in rng.sample(range(200), rng.choice([8, 9, 10, 11, 12, 13, 20])):
            w[k] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(LF.lookalikes, "__defaults__", (4,))
    monkeypatch.setattr(LF.component_links, "__defaults__", (5,))
    assert run(spark, rows, width=2) == brute(rows, 2, 80)
    assert LF.least_agreement(80) == 186 and LF.least_agreement(100) == 288
