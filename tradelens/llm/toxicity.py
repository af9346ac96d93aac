"""Toxicity by a counterfactual-regularised linear classifier.

A text is the set of its words and word beginnings (so inflected and coined forms share
evidence).  A logistic regression over the most telling of them is fitted on a bounded,
documented sample of labelled documents.  For every sampled document that mentions an
identity term a counterfactual is made by swapping the terms within their group; the loss adds
the squared change of the score between the two, so the weight that identity terms (and what
only occurs with them) could take is penalised, and neutral mentions of a group are not
flagged for the mention alone.

Scoring reads whole texts, row by row, and nothing but the text.  Null and empty texts get the
score of the intercept alone.  With no labelled row, or one class alone, the score is that
class's share (0 without rows).  Repeated rows and null ids need no rule: a label whose id is
null or has no document is not used, and a document with several labels counts once for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_process

#: Bound of the training sample: documents of each class.
SAMPLE_PER_CLASS = 2_000
#: Features kept, and the least number of sampled documents that must have one.
FEATURES, LEAST_DOCUMENTS = 4_000, 4
L2, COUNTERFACTUAL = 1e-4, 1.0
THRESHOLD = 0.7
WORD_MEMORY = 300_000
WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)

# Identity terms by group; a term is swapped for the next of its group.
IDENTITY_GROUPS = [
    ["women", "men"], ["woman", "man"], ["girl", "boy"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"], ["muslims", "christians", "jews"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["gay", "straight", "lesbian", "bisexual"], ["trans", "cis"], ["old", "young"], ["immigrant", "native"],
    ["frauen", "männer"], ["femmes", "hommes"], ["mujeres", "hombres"],
]


def swaps(groups: list[list[str]] | None = None) -> dict[str, str]:
    """Each identity term's counterfactual: the next one of its group."""
    return {t: g[(i + 1) % len(g)] for g in (IDENTITY_GROUPS if groups is None else groups) for i, t in enumerate(g)}


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def features_of(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]


def _code(feature: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(feature) >> 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS,
                  groups: list[list[str]] | None = None) -> DataFrame:
    """``(label, share, codes, other)`` of a bounded sample of labelled documents.

    At most ``per_class`` rows of each class, those with the smallest id hash per slot,
    whatever the partitioning; ``share``: the class's labelled rows.  ``codes``: the text's
    feature codes, packed as 64-bit integers; ``other``: those of its counterfactual (empty
    without an identity term).
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    slot = F.pmod(F.xxhash64("id"), F.lit(per_class))
    chosen = marked.groupBy("label", slot.alias("slot")).agg(
        F.min_by("id", F.xxhash64(F.lit(5), F.col("id"))).alias("id"), F.count(F.lit(1)).alias("n"))
    chosen = chosen.select("label", "id", "n")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    swap = swaps(groups)

    @F.pandas_udf("codes binary, other binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                codes = {_code(f) for w in words for f in features_of(w)}
                other = {}
                if words & swap.keys():
                    other = {_code(f) for w in words for f in features_of(swap.get(w, w))}
                out.append(tuple(np.fromiter(x, np.int64, len(x)).tobytes() for x in (codes, other)))
            yield pd.DataFrame(out, columns=["codes", "other"], index=texts.index)

    return rows.select("label", "n", coded("text").alias("c")).select("label", "n", "c.codes", "c.other")


def _index(arrays: list[np.ndarray], kept: np.ndarray) -> list[np.ndarray]:
    out = []
    for a in arrays:
        at = np.searchsorted(kept, a)
        at[at == len(kept)] = 0
        out.append(at[kept[at] == a] if len(kept) else at[:0])
    return out


class _Rows:
    """0/1 rows as index lists, with the two products a gradient step needs."""

    def __init__(self, lists: list[np.ndarray], width: int):
        self.n, self.width = len(lists), width
        self.cols = np.concatenate(lists) if lists else np.empty(0, np.int64)
        self.rows = np.repeat(np.arange(self.n), [len(x) for x in lists])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.cols], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, r[self.rows], self.width)


def fit(sample: DataFrame, features: int = FEATURES, least: int = LEAST_DOCUMENTS, l2: float = L2,
        counterfactual: float = COUNTERFACTUAL, steps: int = 400) -> dict:
    """``{"codes": sorted feature codes, "weights": ..., "intercept": ...}`` from the bounded
    sample.  Classes are weighted by their share of the labelled rows."""
    rows = sample.collect()
    y = np.array([r[0] for r in rows], float)
    none = {"codes": np.empty(0, np.int64), "weights": np.empty(0), "intercept": -40.0}
    if not rows:
        return none
    if y.min() == y.max():
        return none | {"intercept": 40.0 if y[0] else -40.0}
    texts, others = ([np.frombuffer(r[i], np.int64) for r in rows] for i in (2, 3))
    total = np.array([sum(r[1] for r in rows if r[0] == k) for k in (0, 1)], float)
    count = np.array([(y == 0).sum(), (y == 1).sum()], float)
    weight = (total / total.sum() / count)[y.astype(int)]

    # The most telling features: largest gain in log likelihood over the class shares.
    every, all_ = np.unique(np.concatenate(texts), return_counts=True)
    every, all_ = every[all_ >= least], all_[all_ >= least]
    found, times = np.unique(np.concatenate([t for t, k in zip(texts, y, strict=True) if k]), return_counts=True)
    pos = np.zeros(len(every))
    if len(every):
        at = np.minimum(np.searchsorted(every, found), len(every) - 1)
        same = every[at] == found
        pos[at[same]] = times[same]
    rate = (pos + 0.5 * count[1] / len(y)) / (all_ + 0.5)
    base = count[1] / len(y)
    gain = pos * np.log(rate / base) + (all_ - pos) * np.log((1 - rate) / (1 - base))
    best = np.argsort(-gain, kind="stable")[:features]
    kept = np.sort(every[best[gain[best] > 6.0]])

    x = _Rows(_index(texts, kept), len(kept))
    changed = [i for i, o in enumerate(others) if len(o)]
    x0 = _Rows(_index([texts[i] for i in changed], kept), len(kept))
    x1 = _Rows(_index([others[i] for i in changed], kept), len(kept))
    w, b = np.zeros(len(kept)), float(np.log(total[1] / total[0]))
    # Adam on the whole sample: smooth, convex, a few thousand weights.
    m, v, lr = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), 0.05
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -40, 40)))
        r = weight * (p - y)
        g = x.back(r) + l2 * w
        if changed:
            d = (x0.dot(w) - x1.dot(w)) * (2 * counterfactual / len(changed))
            g += x0.back(d) - x1.back(d)
        g = np.append(g, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = lr * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return {"codes": kept, "weights": w, "intercept": float(b)}


class Scorer:
    def __init__(self, model: dict):
        self.at = {int(c): i for i, c in enumerate(model["codes"])}
        self.weights, self.intercept = model["weights"], model["intercept"]
        self.known: dict[str, tuple[int, ...]] = {}

    def score(self, text: str | None) -> float:
        if len(self.known) > WORD_MEMORY:
            self.known = {}
        known, active = self.known, set()
        for w in words_of(text):
            at = known.get(w)
            if at is None:
                at = known[w] = tuple(self.at[c] for c in map(_code, features_of(w)) if c in self.at)
            if at:
                active.update(at)
        z = self.intercept + sum(self.weights[i] for i in sorted(active))
        return float(1 / (1 + np.exp(-min(40.0, max(-40.0, z)))))


def toxicity(text: Column, model: dict) -> Column:
    """The score (0 to 1) of a text column."""
    name = ("toxicity", hash((model["codes"].tobytes(), model["weights"].tobytes())))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = per_process(name, lambda: Scorer(model))
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], index=texts.index, dtype="float64")

    return run(text)
