import random

from tradelens.llm import langid as L

STEMS = {"aa": ["kor", "tun", "velo", "mik", "sar"], "bb": ["ghe", "wiz", "plo", "urth", "enk"], "cc": ["été", "oui", "çan", "quo", "lle"]}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(STEMS))
        text = " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 80)))
        rows.append((i, text.capitalize() + ".", lang))
    return rows


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + [(900, None, "aa"), (901, "x", None)], "doc_id long, text string, lang string")
    model = L.fit(L.training_sample(df.where("doc_id < 200")))
    assert sorted(model) == sorted(STEMS)
    assert L.reduced("½ ²") == L.reduced("Ⅳ ①") == L.reduced("１2_") == "" and L.reduced("½ Kg") == "½ kg"
    odd = [(1000, None, None), (1001, "", None), (1002, "12 + 34 !?", None), (1003, "kortun " * 50_000, None), (None, "wizplo", None)]
    test = spark.createDataFrame(rows[200:] + odd, "doc_id long, text string, lang string")
    got = test.select("doc_id", "lang", L.predict(test.text, model).alias("p")).select("doc_id", "lang", "p.*").collect()
    assert len(got) == 105
    known = [r for r in got if r.lang]
    assert sum(r.lang == r.lang_pred for r in known) / len(known) > 0.98
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert by[i].lang_pred == L.UNKNOWN and by[i].score == 0 and by[i].rejected
    assert by[1003].lang_pred == "aa" and by[None].lang_pred == "bb" and all(0 <= r.score <= 1 for r in got)


def test_narrow_margins_are_rejected_and_no_training_row(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    model = L.fit(L.training_sample(df))
    # A text half in one language, half in another, is closer to neither than a whole one.
    pure, mixed = "kortunvelo miksar tunkor " * 10, ("kortunvelo miksar tunkor " + "ghewizplo urthenk wizghe ") * 5
    c = L.Classifier(model)
    assert c.predict(mixed)[2] < c.predict(pure)[2]
    rows = df.limit(5).select(L.predict(df.text, model, min_margin=9.0).alias("p")).select("p.rejected").collect()
    assert all(r.rejected for r in rows)
    none = L.fit(L.training_sample(df.limit(0)))
    assert none == {} and L.Classifier(none).predict("kor")[0] == L.UNKNOWN
    assert df.limit(0).select(L.predict(df.text, model)).count() == 0
