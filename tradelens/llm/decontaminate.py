"""Benchmark decontamination by winnowing (native DataFrame operations).

Documents and benchmark items are word sequences.  A window is ``window`` consecutive words
of an item; an item of fewer words, but not none, is one window.  A document word is hit if
it lies inside any occurrence of a window.

1. Winnowing: over every stretch of ``window`` words the smallest hash of its ``gram``-word
   grams is kept.  A shared stretch of ``window`` words has the same smallest hash on both
   sides, so every document with an occurring window shares a fingerprint with the benchmark.
   Items shorter than a window are matched by the hash of all their words, against all grams
   of that length (lengths under ``window`` only).
2. The distinct fingerprints of a document are joined with those of the benchmark.
3. Hits are extended in the documents found: the 128-bit hashes of all their windows are
   joined with the items' windows, and occurrences are merged into covered words.

Windows that agree are one class, and items with the same windows are joined only after the
occurrences of a document were reduced to its distinct classes.

Texts: A-Z count as a-z; words are runs of ``WORD_BREAK``'s complement.  Null and empty texts
have no words and are not contaminated; an item without words has no window.  Rows that agree
in id and text are one document, repeated, and get the same result; so do repeated items (the
item id is listed once).  Null item ids are counted and listed as the text ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, keyed_rows, stored

WINDOW, GRAM = 13, 8
#: A document is contaminated if ``SHARE * hit words >= words`` (and any is hit).
SHARE = 20

# Fixed values of the word rule: what separates words, and the letters that are lowered.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["k1", "k2"]


def words(text: Column) -> Column:
    """The words of a text; null gives an empty array."""
    # lower() also lowers other alphabets; it is right, and much faster, for ASCII alone.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, WORD_BREAK), ""), F.array().cast("array<string>"))


def _cut(values: Column, n: Column | int) -> Column:
    """All but the last ``n`` elements (none, if there are fewer)."""
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - n, F.lit(0)))


def _pair_up(values: str, step: int) -> Column:
    """At each place the hash of the two elements ``step`` apart."""
    return F.transform(_cut(F.col(values), step), lambda v, i: F.xxhash64(v, F.get(F.col(values), i + step)))


def _least(left: str, right: str, step: int) -> Column:
    return F.transform(_cut(F.col(right), step), lambda v, i: F.least(F.get(F.col(left), i), F.get(F.col(right), i + step)))


def gram_hashes(rows: DataFrame, hashes: str, lengths: list[int]) -> DataFrame:
    """Adds ``{hashes}_{n}``: the rolling hashes of every stretch of n words, for each n.

    Built by doubling: a stretch of n words is the pair of the two stretches of the largest
    power of two p <= n that begin at its start and end at its end.
    """
    power = 1
    rows = rows.withColumn(f"{hashes}_p1", F.col(hashes))
    while power * 2 <= max(lengths, default=1):
        rows = rows.withColumn(f"{hashes}_p{power * 2}", _pair_up(f"{hashes}_p{power}", power))
        power *= 2
    for n in lengths:
        p = 1 << (n.bit_length() - 1)
        rows = rows.withColumn(f"{hashes}_{n}", F.col(f"{hashes}_p{p}") if n == p else _pair_up(f"{hashes}_p{p}", n - p))
    return rows


def winnowed(rows: DataFrame, grams: str, span: int, out: str) -> DataFrame:
    """Adds ``out``: the distinct minima of every ``span`` consecutive gram hashes."""
    power = 1
    rows = rows.withColumn("m_1", F.col(grams))
    while power * 2 <= span:
        rows = rows.withColumn(f"m_{power * 2}", _least(f"m_{power}", f"m_{power}", power))
        power *= 2
    top = F.col(f"m_{power}") if power == span else _least(f"m_{power}", f"m_{power}", span - power)
    return rows.withColumn(out, F.array_distinct(top))


def _fingerprints(rows: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``rows`` (with ``words``) reduced to ``keep`` columns plus the array ``prints``."""
    keep = [c for c in rows.columns if c != "words"]
    rows = rows.withColumn("w", F.transform("words", lambda x: F.xxhash64(x)))
    rows = gram_hashes(rows, "w", sorted({gram, *short}))
    rows = winnowed(rows, f"w_{gram}", window - gram + 1, "prints")
    # A text of fewer words than a window has no full window of grams.
    rows = rows.withColumn("prints", F.when(F.size("w") >= window, F.col("prints")).otherwise(F.array().cast("array<long>")))
    for n in short:
        rows = rows.withColumn("prints", F.concat("prints", F.array_distinct(F.col(f"w_{n}"))))
    return rows.select(*keep, "prints")


def _window_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per window of the given lengths: ``keep`` columns, ``n``, ``pos``, ``a``, ``b``.

    ``a`` and ``b`` are independent 64-bit hashes of the window's words.  The outer form of the
    generator keeps the optimizer from pushing a copy of the whole hash chain below it as a
    filter on its size."""
    keep = [c for c in rows.columns if c != "words"]
    rows = rows.withColumn("x", F.transform("words", lambda v: F.xxhash64(v)))
    rows = rows.withColumn("y", F.transform("words", lambda v: F.xxhash64(F.lit(7), v)))
    rows = gram_hashes(gram_hashes(rows, "x", lengths), "y", lengths)
    out = None
    for n in lengths:
        one = rows.select(*keep, F.lit(n).alias("n"), F.posexplode_outer(F.arrays_zip(
            F.col(f"x_{n}").alias("a"), F.col(f"y_{n}").alias("b"))).alias("pos", "h"))
        one = one.where("pos is not null").select(*keep, "n", "pos", F.col("h.a").alias("a"), F.col("h.b").alias("b"))
        out = one if out is None else out.unionByName(one)
    return out


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             gram: int = GRAM) -> DataFrame:
    """Per document: ``id_col, k1, k2, n_words, n_hit, n_items, item_ids`` (sorted as text)."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    name = "decontaminate"
    bench = stored(items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("null")).alias("item"),
                                words(F.col(item_text_col)).alias("words")).where(F.size("words") > 0),
                   f"{name}-items")
    # At most window - 1 values, whatever the size of the benchmark.
    short = sorted(r[0] for r in bench.select(F.size("words").alias("n")).where(F.col("n") < window).distinct().collect())
    full = bench.where(F.size("words") >= window)
    classes = _window_hashes(full, [window])
    for n in short:
        classes = classes.unionByName(_window_hashes(bench.where(F.size("words") == n), [n]))
    classes = stored(classes.select("item", "n", "a", "b").distinct(), f"{name}-windows")
    windows = stored(classes.select("n", "a", "b").distinct(), f"{name}-classes")

    prints = _fingerprints(full.select("words"), window, gram, [])
    prints = prints.select(F.explode_outer("prints").alias("print"))
    for n in short:
        one = gram_hashes(bench.where(F.size("words") == n).select(
            F.transform("words", lambda x: F.xxhash64(x)).alias("w")), "w", [n])
        prints = prints.unionByName(one.select(F.explode_outer(F.col(f"w_{n}")).alias("print")))
    prints = stored(prints.where("print is not null").distinct(), f"{name}-prints").withColumn("known", F.lit(1))

    rows = docs.select(F.col(id_col).alias("id"), *doc_key(id_col, text_col), words(F.col(text_col)).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = _fingerprints(rows, window, gram, short)
    rows = rows.select("id", *_KEY, "n_words", F.explode_outer("prints").alias("print"))
    # A row per document; repeated rows of a document are kept apart only in the last join.
    base = rows.join(prints, "print", "left").groupBy(*_KEY).agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.max("known").alias("known"))
    base = stored(base, f"{name}-documents")

    found = base.where("known = 1").select(*_KEY)
    texts = docs.select(*doc_key(id_col, text_col), F.col(text_col).alias("text")).join(found, _KEY, "left_semi")
    texts = texts.groupBy(*_KEY).agg(F.first("text").alias("text")).select(*_KEY, words(F.col("text")).alias("words"))
    lengths = [*short, window]
    hits = stored(_window_hashes(texts, lengths).join(windows, ["n", "a", "b"]).select(*_KEY, "n", "pos", "a", "b"),
                  f"{name}-hits")
    # Covered words: what each occurrence adds beyond the furthest end before it.
    doc = Window.partitionBy(*_KEY).orderBy("pos", "n")
    end = F.max(F.col("pos") + F.col("n")).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    added = hits.select(*_KEY, "pos", "n", F.coalesce(end, F.lit(0)).alias("end"))
    covered = added.groupBy(*_KEY).agg(F.sum(F.greatest(
        F.col("pos") + F.col("n") - F.greatest("pos", "end"), F.lit(0))).cast("long").alias("n_hit"))
    met = stored(hits.select(*_KEY, "n", "a", "b").distinct(), f"{name}-met").join(classes, ["n", "a", "b"])
    met = met.groupBy(*_KEY).agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    result = stored(covered.join(met, _KEY), f"{name}-found")
    return base.join(result, _KEY, "left").select(
        F.col("id").alias(id_col), *_KEY, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contaminated(share: int = SHARE) -> Column:
    """The decision from ``n_hit`` and ``n_words``."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        share: int = SHARE, **options) -> DataFrame:
    """``docs`` without the contaminated ones; every column stays."""
    bad = stored(overlaps(docs, items, id_col, text_col, **options).where(contaminated(share)).select("k1", "k2"),
                 "decontaminate-bad")
    return keyed_rows(docs, id_col, text_col).join(bad.hint("merge"), ["k1", "k2"], "left_anti").select("row.*")
