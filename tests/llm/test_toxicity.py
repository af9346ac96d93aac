import random

import numpy as np

from tradelens.llm import toxicity as T


def tables(spark, n=900, seed=4):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "am", "con") for b in ("em", "um", "or", "et", "is")]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilen", "vilest", "vilous", "rotter"])
        # Identity terms are mentioned more often in toxic texts, but mean nothing.
        if rng.random() < (0.8 if toxic else 0.1):
            words.append(rng.choice(["muslim", "gay", "women"]))
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + [(None, 1), (10**6, 0), (1, None)], "doc_id long, toxic int"), docs, dict(labels))


def test_held_out_accuracy_and_counterfactual_penalty(spark):
    docs, labels, texts, truth = tables(spark)
    sample = T.training_rows(docs, labels.where("doc_id < 600"))
    plain, fair = T.fit(sample, counterfactual=0.0), T.fit(sample, counterfactual=20.0)
    scorer = T.Scorer(fair)
    held = [(scorer.score(t), truth[i]) for i, t in texts if i >= 600]
    assert np.mean([(s >= T.THRESHOLD) == bool(y) for s, y in held]) > 0.97
    neutral, mention = "lorem ipsum dolor sitet", "lorem ipsum dolor sitet muslim gay women"
    rise = [T.Scorer(m).score(mention) - T.Scorer(m).score(neutral) for m in (plain, fair)]
    swapped = "lorem ipsum dolor sitet christian straight men"
    change = [abs(T.Scorer(m).score(mention) - T.Scorer(m).score(swapped)) for m in (plain, fair)]
    assert rise[1] < rise[0] and change[1] < change[0] and T.Scorer(fair).score(mention) < T.THRESHOLD


def test_column_on_odd_texts_and_empty_training(spark):
    docs, labels, *_ = tables(spark, 80)
    none = T.fit(T.training_rows(docs, labels.limit(0)))
    assert T.Scorer(none).score("anything") < 1e-9
    one = T.fit(T.training_rows(docs, labels.where("toxic = 1")))
    assert T.Scorer(one).score("anything") > 0.99
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "rotter " * 50_000), (None, "x"), (3, "12 !!")],
                                "doc_id long, text string")
    model = T.fit(T.training_rows(docs, labels))
    got = odd.select("doc_id", T.toxicity(odd.text, model).alias("score")).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert odd.limit(0).select(T.toxicity(odd.text, model)).count() == 0
