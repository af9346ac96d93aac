"""Personal data by candidate spans and gradient-boosted trees.

1. High-recall generators propose overlapping spans of four kinds: the base rules below, and
   looser forms (addresses written with "at" and "dot" in any case, up to each of their labels;
   every part of a run of digit groups with any separators that is long enough; dotted numbers).
2. Boosted trees score every proposed span from its format (digits, separators, groups,
   checksum, length) and its context (neighbouring characters, telling words before it).
3. Per kind, a threshold calibrated on held-out candidates selects redactions.

Base spans always stay; the trees add spans to them.  There are no human labels: the trees
learn from a bounded, documented sample of documents, and only from candidates that could be
added.  Personal ones are made: a base span is rewritten, in its own context, into one of the
looser forms of its kind that the base rules do not find (see ``loosened``).  Candidates that
hold a part of such a form or more than it count as not personal, and so do the candidates of
the documents as they are that meet no base span, unless something besides the base rules
speaks for them (see ``vouched``): those may well be personal and are left out.  So the trees carry the base rules' evidence
over to looser forms that stand where base spans stand, and calibration takes it that a
corpus holds a looser form for every base span.  An added span that overlaps a base span or a
better added span is not kept.

Base rules, leftmost non-overlapping per kind (a match that fails its check is dropped and
not retried): see ``base_spans``.  Offsets are code points, the end is exclusive.

Texts: null counts as empty.  Every text is read whole, in time linear in its length, row by
row; repeated rows and null ids need no rule.  Without any training candidate nothing is added.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: documents, and candidates of one document (as many again of
#: its base spans are rewritten).
SAMPLE_DOCUMENTS, SAMPLE_CANDIDATES = 4_000, 200
#: Share of held-out addable candidates over a threshold that must count as personal.
TARGET_PRECISION = 0.98
#: Characters kept on each side of a rewritten span.
CONTEXT = 64
#: Candidates scored at once.
SCORED = 4_096

# The base rules' characters and patterns.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the start of a run of digits: from inside it, the same text fails
# or matches as from its start.  The look-behind keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser forms.
_AT, _DOT = r" ?(?:\(at\)|\[at\]|\bat\b|@) ?", r" ?(?:\(dot\)|\[dot\]|\bdot\b|\.) ?"
_WORDED = re.compile(rf"(?<![\w.+-])[\w.+-]{{1,64}}{_AT}[\w-]{{1,63}}((?:{_DOT}[\w-]{{1,63}}){{1,4}})", re.I)
_LABEL = re.compile(rf"{_DOT}[\w-]{{1,63}}", re.I)
#: The part of ``_WORDED`` from the "at" to the first "dot": without it there is no match.
_AT_DOT = re.compile(rf"{_AT}[\w-]{{1,63}}{_DOT}[\w-]", re.I)
_GROUP = re.compile(r"[0-9]+")
_RUN = re.compile(r"[0-9]+(?:[\x20()./-]{1,3}[0-9]+)*")
_DOTTED = re.compile(r"(?<![\w.])[0-9]{1,3}(?:[.:][0-9]{1,3}){3,5}(?![\w.])")
_NEEDED = re.compile(r"[0-9@]|\bat\b", re.I)
_BRACKETED = re.compile(r"\(at\)|\[at\]", re.I)
_TELLING = {
    "email": re.compile(r"mail|contact|write|adresse|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|anruf|appel", re.I),
}


# --------------------------------------------------------------------------- base rules

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each "@"."""
    out, start, at = [], 0, text.find("@")
    while at >= 0:
        before = text[start:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        if m:
            out.append((at - local, m.end()))
        start = m.end() if m else at + 1
        at = text.find("@", start)
    return out


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)``, by kind as listed in ``KINDS``, then start."""
    out = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    out += [("card", *m.span()) for m in _CARD.finditer(text)
            if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --------------------------------------------------------------------------- candidates

def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """High-recall proposals, overlapping ones included; base spans come first."""
    out = dict.fromkeys(base)
    if _AT_DOT.search(text):
        for m in _WORDED.finditer(text):
            # The domain may end at any of its labels: a sentence may follow the address.
            out |= dict.fromkeys(("email", m.start(), x.end()) for x in _LABEL.finditer(text, m.start(1), m.end()))
    for run in _RUN.finditer(text):
        out |= dict.fromkeys(_numbers(text, *run.span()))
    out |= dict.fromkeys(("ip", *m.span()) for m in _DOTTED.finditer(text))
    return list(out)


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """The parts of a run of digit groups that begin and end at groups and have the digits of a
    phone (7 to 15) or card number (12 to 20), with a "+" and "(" before them.  A group that
    touches a letter is no end of one.  At most 20 groups fit, so the work is linear."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    for i, (first, _) in enumerate(groups):
        first -= text[first - 1:first] == "+"
        first -= text[first - 1:first] == "("
        if text[first - 1:first].isalpha() or text[first - 1:first] == "_":
            continue
        n = 0
        for a, b in groups[i:i + 20]:
            n += b - a
            if n > 20:
                break
            if n < 7 or text[b:b + 1].isalpha() or text[b:b + 1] == "_":
                continue
            if n <= 15:
                yield "phone", first, b
            if n >= 12:
                yield "card", first, b


def features(text: str, span: tuple[str, int, int]) -> list[float]:
    """Format and context of a span, as numbers."""
    kind, start, end = span
    body = text[start:end]
    digits = _digits(body)
    before, after = text[max(0, start - 32):start], text[end:end + 8]
    groups = re.findall(r"[0-9]+", body)
    domain = body.rpartition("@")[2] if "@" in body else ""
    low = body.lower()
    return [
        float(bool(_BRACKETED.search(body))), float(low.count("dot")), float(body.count(". ")),
        float(len(body) - len(body.rstrip(_LETTERS))), float(body.count("/")), float(body.count(":")),
        float(len(_digits(before[-3:]))), float(len(_digits(after[:3]))),
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(groups)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(13 <= len(digits) <= 19 and luhn(digits)), float(body.startswith("+")), float("(" in body),
        float(body.count(".")), float(body.count("-")), float(body.count(" ")), float("@" in body),
        float(sum(c.isalpha() for c in body)), float(domain.count(".")),
        float(all(int(g[-4:]) <= 255 and len(g) <= 3 for g in groups) and len(groups) == 4),
        float(bool(_TELLING[kind].search(before))), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before[-1:] in "=:#$€"), float(sum("0" <= c <= "9" for c in before)), float(len(set(digits))),
    ]


def loosened(kind: str, body: str) -> list[str]:
    """Looser ways to write the text of a base span."""
    groups = re.findall(r"[0-9]+", body)
    if kind == "email":
        local, _, domain = body.partition("@")
        ats = (" at ", " (at) ", "(at)", "[at]", " [at] ", " AT ")
        return [local + at + domain.replace(".", dot) for at in ats for dot in (".", " dot ", " (dot) ", "[dot]")]
    if kind == "ip":
        a, b, c, d = groups
        return [f"{a}:{b}:{c}:{d}", f"{a}.{b}.{c}:{d}", f"{a}:{b}.{c}.{d}"]
    if kind == "card":
        if len(groups) == 1:
            groups = [body[i:i + 4] for i in range(0, len(body), 4)]
        return [sep.join(groups) for sep in (".", "/", "  ", " - ")]
    out, rest = [body[1:]], groups[1:]
    for held in (groups, rest) if len(groups[0]) <= 3 else (groups,):
        out += [sep.join(held) for sep in ("-", ".", " ", "/")]
    if len(rest) > 1:
        out.append(f"({rest[0]}) {'-'.join(rest[1:])}")
    return out


def overlaps(a: tuple[str, int, int], b: tuple[str, int, int]) -> bool:
    return a[1] < b[2] and b[1] < a[2]


# --------------------------------------------------------------------------- boosted trees

class Boosted:
    """Gradient-boosted depth-limited trees for the logistic loss, on binned features."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.base, self.edges, self.nodes = -40.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        if not len(y) or y.min() == y.max():
            self.base = 40.0 if len(y) and y[0] else -40.0
            return self
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        z = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(b, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.nodes.append(tree)
            z += self._apply(tree, b)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, b, g, h, rows, depth):
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = self.rate * gs / (hs + 1.0)
        if depth == 0 or len(rows) < 10:
            return leaf
        best = (1e-6, None, None)
        for j in range(b.shape[1]):
            col = b[rows, j]
            gl, hl = np.bincount(col, g[rows]).cumsum()[:-1], np.bincount(col, h[rows]).cumsum()[:-1]
            if not len(gl):
                continue
            gain = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        if best[1] is None:
            return leaf
        _, j, k = best
        left = b[rows, j] <= k
        return j, k, self._grow(b, g, h, rows[left], depth - 1), self._grow(b, g, h, rows[~left], depth - 1)

    def _apply(self, tree, b: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(b), tree)
        j, k, left, right = tree
        return np.where(b[:, j] <= k, self._apply(left, b), self._apply(right, b))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        if self.nodes and len(x):
            b = self._binned(x)
            for tree in self.nodes:
                z += self._apply(tree, b)
        return 1 / (1 + np.exp(-z))


def addable(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The candidates that meet no base span."""
    taken = _Disjoint(base)
    return [c for c in candidates(text, base) if taken.free(c[1], c[2])]


def vouched(text: str, span: tuple[str, int, int]) -> bool:
    """Whether a telling word, a card's checksum or a bracketed "at" speaks for a span."""
    kind, start, end = span
    body = text[start:end]
    return bool(_TELLING[kind].search(text[max(0, start - 32):start])
                or (kind == "card" and 13 <= len(d := _digits(body)) <= 19 and luhn(d))
                or (kind == "email" and _BRACKETED.search(body)))


def examples(text: str) -> list[tuple[str, tuple[str, int, int], int]]:
    """``(text, candidate, personal)`` to learn from; the text is the one the span lies in."""
    base = base_spans(text)
    out = [(text, c, 0) for c in _spread([c for c in addable(text, base) if not vouched(text, c)])]
    for kind, start, end in _spread(base):
        body, before, after = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
        if len(body) > 4 * CONTEXT:
            continue
        forms = loosened(kind, body)
        first = zlib.crc32(f"{start} {before}{body}".encode("utf-8", "replace"))
        for i in range(len(forms)):
            form = forms[(first + i) % len(forms)]
            want = (kind, len(before), len(before) + len(form))
            context = before + form + after
            found = [c for c in addable(context, base_spans(context)) if overlaps(c, want)]
            if want in found:
                out += [(context, c, int(c == want)) for c in found]
                break
    return out


def _spread(spans: list) -> list:
    """At most ``SAMPLE_CANDIDATES`` of the spans, evenly spaced."""
    return spans[::max(1, -(-len(spans) // SAMPLE_CANDIDATES))]


def training_rows(docs: DataFrame, text_col: str = "text", documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``(fold, kind, personal, x)``: ``examples`` of a bounded sample of documents, with their
    features as packed 32-bit floats.

    The documents are those with the smallest text hash per slot, whatever the partitioning,
    of those with a digit, an address sign or the word "at"."""
    text = F.col(text_col)
    h = F.xxhash64(text)
    rows = docs.where(text.rlike(r"(?i)[0-9@]|\bat\b")).groupBy(F.pmod(h, F.lit(documents)).alias("slot")).agg(
        F.min(F.struct(h.alias("h"), text.alias("text"))).alias("m")).select("m.h", "m.text")

    @F.pandas_udf("array<struct<kind:int, personal:int, x:binary>>")
    def proposed(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            out.append([{"kind": KINDS.index(c[0]), "personal": personal,
                         "x": np.array(features(t, c), "<f4").tobytes()} for t, c, personal in examples(text)])
        return pd.Series(out, index=texts.index, dtype=object)

    return rows.select(F.pmod("h", F.lit(5)).alias("fold"), F.explode(proposed("text")).alias("c")).select("fold", "c.*")


def fit(sample: DataFrame, precision: float = TARGET_PRECISION) -> dict:
    """Trees from four folds of the bounded sample, thresholds per kind from the fifth."""
    rows = sample.collect()
    x = np.frombuffer(b"".join(r[3] for r in rows), "<f4").reshape(len(rows), len(rows[0][3]) // 4 if rows else 0)
    y, kind = np.array([r[2] for r in rows], float), np.array([r[1] for r in rows], int)
    held = np.array([r[0] == 0 for r in rows], bool)
    trees = Boosted().fit(x[~held], y[~held])
    thresholds = {}
    for k, name in enumerate(KINDS):
        pick = held & (kind == k)
        p, t = trees.predict(x[pick]), y[pick]
        order = np.argsort(-p, kind="stable")
        p, t = p[order], t[order]
        share = np.cumsum(t) / np.arange(1, len(t) + 1)
        # The lowest score whose whole upper part is precise enough; none: nothing is added.
        ends = np.flatnonzero(np.append(p[1:] < p[:-1], True) & (share >= precision)) if len(t) else []
        thresholds[name] = max(0.5, float(p[ends[-1]])) if len(ends) else 2.0
    return {"trees": trees, "thresholds": thresholds}


# --------------------------------------------------------------------------- redaction

def find(text: str | None, model: dict | None) -> tuple[list, list]:
    """``(base spans, all spans)`` of a text, each by kind as listed, then start."""
    if not text or not _NEEDED.search(text):
        return [], []
    base = base_spans(text)
    if model is None:
        return base, base
    loose = addable(text, base)
    if not loose:
        return base, base
    chosen = []
    for at in range(0, len(loose), SCORED):
        part = loose[at:at + SCORED]
        score = model["trees"].predict(np.array([features(text, c) for c in part], "<f4"))
        chosen += [(-s, c) for s, c in zip(score, part, strict=True) if s >= model["thresholds"][c[0]]]
    chosen.sort()
    # What is taken, as disjoint sorted spans: a new span meets at most its two neighbours.
    taken = _Disjoint(base)
    added = [c for _, c in chosen if taken.add(c[1], c[2])]
    return base, sorted(base + added, key=lambda c: (KINDS.index(c[0]), c[1], c[2]))


class _Disjoint:
    """Sorted disjoint intervals that accept another only if it meets none."""

    def __init__(self, spans):
        self.ends: list[tuple[int, int]] = []
        for _, start, end in sorted(spans, key=lambda c: c[1:]):
            if self.ends and start < self.ends[-1][1]:
                self.ends[-1] = (self.ends[-1][0], max(end, self.ends[-1][1]))
            else:
                self.ends.append((start, end))

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.ends, (start, end))
        return not ((i and self.ends[i - 1][1] > start) or (i < len(self.ends) and self.ends[i][0] < end))

    def add(self, start: int, end: int) -> bool:
        if not self.free(start, end):
            return False
        insort(self.ends, (start, end))
        return True


def personal_spans(text: Column, model: dict | None) -> Column:
    """``struct<base, spans>``: arrays of ``struct<kind, start, end>`` (code points)."""
    span = "array<struct<kind:string, start:int, end:int>>"

    @F.pandas_udf(f"struct<base:{span}, spans:{span}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(spans):
            return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        for texts in batches:
            found = [find(t, model) for t in texts]
            yield pd.DataFrame({"base": [rows(b) for b, _ in found], "spans": [rows(s) for _, s in found]},
                               index=texts.index)

    return run(text)


def redact(text: Column, model: dict | None) -> Column:
    """The text with every span replaced by its kind in brackets; overlaps merge."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for kind, start, end in sorted(find(t, model)[1], key=lambda c: c[1:]):
                if start >= at:
                    out += [t[at:start], f"[{kind}]"]
                at = max(at, end)
            return "".join(out) + t[at:]

        for texts in batches:
            yield pd.Series([one(t) for t in texts], index=texts.index, dtype=object)

    return run(text)
