import random

from tradelens.llm import line_dedup as LD


def brute(rows, min_words):
    """Delete lines in any run of >= min_words words that occurs at an earlier place."""
    seqs = []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [] if t is None else t.split("\n")
        seqs.append((i, t, [(p, x.strip()) for p, x in enumerate(lines) if x.strip()]))
    seen, out = {}, {}
    for d, (_, _, seq) in enumerate(seqs):
        for a in range(len(seq)):
            for b in range(a, len(seq)):
                seen.setdefault(tuple(x for _, x in seq[a:b + 1]), (d, a))
    for d, (i, t, seq) in enumerate(seqs):
        gone = set()
        for a in range(len(seq)):
            for b in range(a, len(seq)):
                run = tuple(x for _, x in seq[a:b + 1])
                if sum(len(x.split()) for x in run) >= min_words and seen[run] < (d, a):
                    gone |= {p for p, _ in seq[a:b + 1]}
        out[(i, t)] = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
    return out


def check(spark, rows, min_words):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_deleted string")
    want = brute(rows, min_words)
    done = LD.dedup_lines(df, min_words=min_words).collect()
    got = {}
    for r in done:
        got.setdefault((r.doc_id,), []).append(r.text)
    assert len(done) == len(rows)
    expect = {}
    for i, t in rows:
        expect.setdefault((i,), []).append(want[(i, t)])
    key = lambda x: (x is not None, x or "")
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in expect.items()}


def test_runs_against_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a b", "c", "d e f", "g", " c ", "", "h i j k l", "m"]
    rows = []
    for i in range(40):
        lines = [rng.choice(vocab) for _ in range(rng.randint(0, 9))]
        if rows and rng.random() < 0.4:
            lines += (rows[rng.randrange(len(rows))][1] or "").split("\n")[:rng.randint(1, 6)]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (3, rows[3][1]), (102, "c\n" * 30)]
    check(spark, rows, 6)


def test_single_long_lines_and_copies(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"head one\n{long}\ntail"), (2, f"{long}"), (3, f"other\n{long}\nmore"),
            (4, f"head one\n{long}\ntail"), (None, "short\nshort"), (7, "short")]
    check(spark, rows, 50)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in LD.dedup_lines(df).collect()}
    assert got[2] == "" and got[3] == "other\nmore" and got[4] == "" and got[1].count("\n") == 2


def test_clashing_names_stay_as_they_are(spark):
    names = ["k1", "k2", "lines", "positions", "rest", "row", "at", "__k1", "__drop"]
    df = spark.createDataFrame([(1, "a b\nc", *names), (2, "a b\nc", *names), (3, None, *names)],
                               "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    done = LD.dedup_lines(df, min_words=2)
    assert done.columns == [*df.columns, "n_deleted"]
    rows = {r.doc_id: r for r in done.collect()}
    assert [rows[i].text for i in (1, 2, 3)] == ["a b\nc", "", None]
    assert all([r[n] for n in names] == names for r in rows.values())


def test_the_text_is_hashed_once_per_document(spark):
    """No hash of the text lies above the explosion into lines, which does not carry the text."""
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = LD.line_table(df, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    above, explode, below = plan.partition("Generate ")
    assert explode and "xxhash64(text" not in above and "xxhash64(1, text" not in above and "xxhash64(1, text" in below
    assert "text#" not in above + below.split("\n")[0]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, k1 string")
    out = LD.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "k1", "n_deleted"] and out.count() == 0
