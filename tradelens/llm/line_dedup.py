"""Line deduplication by a suffix array over line-id sequences (native DataFrame operations).

Every document is a sequence of lines.  A *run* is a stretch of consecutive lines of one
document; it is a *later copy* if the same lines occur at an earlier place (smaller document
id first, then smaller line number).  Deleted is every line that lies in a later copy of at
least ``min_words`` words; the first occurrence always stays.

The suffixes of all sequences are ranked by distributed prefix doubling: ranks by the first
2**k lines come from the pairs of ranks by the first 2**(k-1) lines, numbered in sorted order
over range partitions.  Suffixes alone in their rank share no longer prefix with any other and
drop out, so the work shrinks with every level.

All suffixes that share their first n lines are neighbours in the suffix array: one interval
of longest common prefix >= n, identified by n and the two overlapping ranks of 2**k lines
that cover it (2**k <= n < 2**(k+1)).  A run of at least ``min_words`` words is the union of
the shortest such runs anchored at its lines to the right and to the left: take a line of a
copied run; the run cut off at that line either has enough words, then the shortest run that
ends there is copied too, or has not, then the shortest run that begins at the copied run's
start reaches past it.  So the intervals of the shortest anchored runs give exactly the lines
of all maximal repeated runs.  Every line has a word, so these runs have at most ``min_words``
lines and the doubling ends after log2(min_words) levels at any input size.

Texts: lines are compared without leading and trailing white space; blank lines (no word) are
no part of the sequences and always stay.  Null and empty texts have no lines.  Rows that
agree in id and text are one document, repeated, and get the same result.  Null ids come
first; rows of one id with different texts are ordered by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, stored

MIN_WORDS = 50
# Fixed value: the characters trimmed from both ends of a line before it is compared.
TRIMMED = " \t\r\x0b\x0c"
_KEY = ["k1", "k2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a word: document key, place, words, and a 128-bit line id."""
    # The keys are computed once per document, below the explosion, and the text stays there.
    rows = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("id"), _lines(F.col(text_col)).alias("lines"))
    rows = rows.select(*_KEY, "id", F.posexplode("lines").alias("pos", "line")).select(*_KEY, "id", "pos", F.trim("line", F.lit(TRIMMED)).alias("line"))
    return rows.where(F.col("line") != "").select(
        *_KEY, "id", "pos", F.greatest(F.regexp_count("line", F.lit("\\S+")), F.lit(1)).cast("long").alias("words"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def anchored_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines numbered without gaps (``at``), with the ends of the shortest runs of at least
    ``min_words`` words that begin (``to_at``) and end (``from_at``) at each line."""
    doc = Window.partitionBy(*_KEY)
    by_pos = doc.orderBy("pos")
    once = lines.repartition(*_KEY).withColumn("copy", F.row_number().over(Window.partitionBy(*_KEY, "pos").orderBy("pos")))
    rows = once.where("copy = 1").drop("copy")
    rows = rows.withColumn("at", F.row_number().over(by_pos).cast("long")).withColumn(
        "upto", F.sum("words").over(by_pos))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    right = doc.orderBy("before").rangeBetween(0, min_words - 1)
    left = doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    rows = rows.withColumn("to_at", F.max("at").over(right)).withColumn("to_upto", F.max("upto").over(right))
    rows = rows.withColumn("from_at", F.min("at").over(left)).withColumn("from_before", F.min("before").over(left))
    enough_right = F.col("to_upto") - F.col("before") >= min_words
    enough_left = F.col("upto") - F.col("from_before") >= min_words
    return rows.select(*_KEY, "id", "pos", "at", "h1", "h2",
                       F.when(enough_right, F.col("to_at")).alias("to_at"),
                       F.when(enough_left, F.col("from_at")).alias("from_at"))


def _numbered(pairs: DataFrame, name: str) -> DataFrame:
    """Distinct sorted pairs ``(a, b)`` with their number in the sorted order as ``rank``.

    The pairs are dealt by range and stored; each partition numbers its own, on top of the
    sizes of the partitions before it (one row per partition).
    """
    dealt = pairs.repartitionByRange(F.col("a"), F.col("b")).sortWithinPartitions("a", "b")
    table = stored(dealt.select("a", "b", F.spark_partition_id().alias("part"),
                                F.monotonically_increasing_id().alias("n")), name)
    # The sizes: one row per partition, however many pairs there are.
    sizes = table.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return table.join(F.broadcast(start), "part").select(
        "a", "b", (F.col("start") + F.col("n") - F.col("first")).alias("rank"))


def repeated_suffixes(runs: DataFrame, name: str) -> DataFrame:
    """The lines of ``runs`` that occur more than once, with the ``rank`` of their line id."""
    shared = runs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    names = stored(_numbered(shared.select(F.col("h1").alias("a"), F.col("h2").alias("b")), f"{name}-sort0"),
                   f"{name}-names0")
    found = runs.join(names, (runs["h1"] == names["a"]) & (runs["h2"] == names["b"]))
    return stored(found.select(*_KEY, "id", "pos", "at", "to_at", "from_at", "rank"), f"{name}-ranks0")


def suffix_ranks(first: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """For k = 0 .. ``levels``: ``(k1, k2, at, rank)`` of the suffixes that share their first
    2**k lines with another one.  Ends early once none is left."""
    out = [first.select(*_KEY, "at", "rank")]
    for k in range(1, levels + 1):
        half = out[-1]
        ahead = half.select(*_KEY, (F.col("at") - (1 << (k - 1))).alias("at"), F.col("rank").alias("b"))
        pairs = half.withColumnRenamed("rank", "a").join(ahead, [*_KEY, "at"])
        pairs = stored(pairs.select(*_KEY, "at", "a", "b"), f"{name}-pairs{k}")
        twice = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
        names = stored(_numbered(twice, f"{name}-sort{k}"), f"{name}-names{k}")
        ranks = stored(pairs.join(names, ["a", "b"]).select(*_KEY, "at", "rank"), f"{name}-ranks{k}")
        if ranks.isEmpty():
            break
        out.append(ranks)
    return out


def later_copies(first: DataFrame, ranks: list[DataFrame], name: str) -> DataFrame:
    """``(k1, k2, from_at, to_at)`` of the anchored runs that occur at an earlier place."""
    ends = first.select(*_KEY, "id", "at", "to_at").where("to_at is not null").withColumnRenamed("at", "from_at")
    starts = first.select(*_KEY, "id", F.col("at").alias("to_at"), "from_at").where("from_at is not null")
    n = F.col("to_at") - F.col("from_at") + 1
    both = ends.select(*_KEY, "id", "from_at", "to_at").unionByName(starts.select(*_KEY, "id", "from_at", "to_at"))
    # 2**k <= n < 2**(k+1), from the number's binary digits.
    both = both.withColumn("n", n).withColumn("k", F.length(F.bin("n")) - 1)
    out = None
    for k, rank in enumerate(ranks):
        here = both.where(F.col("k") == k)
        begin = rank.select(*_KEY, F.col("at").alias("from_at"), F.col("rank").alias("a"))
        end = rank.select(*_KEY, (F.col("at") + (1 << k) - 1).alias("to_at"), F.col("rank").alias("b"))
        found = here.join(begin, [*_KEY, "from_at"])
        found = found.withColumn("b", F.col("a")) if k == 0 else found.join(end, [*_KEY, "to_at"])
        found = found.select("k", "n", "a", "b", *_KEY, "id", "from_at", "to_at")
        out = found if out is None else out.unionByName(found)
    spots = stored(out.distinct(), f"{name}-spots")
    place = F.struct(F.col("id").isNotNull().alias("has_id"), "id", "k2", "from_at")
    interval = ["k", "n", "a", "b"]
    origins = stored(spots.groupBy(*interval).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("size"))
                   .where("size > 1").select(*interval, "first"), f"{name}-intervals")
    return spots.join(origins, interval).where(place != F.col("first")).select(*_KEY, "from_at", "to_at")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``(k1, k2, positions)``: the line numbers (from 0) to delete, of documents with any."""
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    name = "line-dedup"
    runs = stored(anchored_runs(line_table(docs, id_col, text_col), min_words), f"{name}-runs")
    first = repeated_suffixes(runs, name)
    ranks = suffix_ranks(first, min_words.bit_length() - 1, name)
    spans = later_copies(first, ranks, name)
    covered = spans.select(*_KEY, F.explode(F.sequence("from_at", "to_at")).alias("at")).distinct()
    places = first.select(*_KEY, "at", "pos").join(covered, [*_KEY, "at"])
    return places.groupBy(*_KEY).agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted from ``text_col``, and the long
    column ``n_deleted`` (lines deleted; it replaces a column of that name).

    A text all of whose lines go becomes empty; a null text stays null.
    """
    drop = stored(repeated_lines(docs, id_col, text_col, min_words), "line-dedup-drop")
    # The text travels as its lines, so they are split once, before the join; the other columns
    # travel in a struct, where no name clashes.
    others = [c for c in docs.columns if c not in (text_col, "n_deleted")]
    rest = F.struct(F.lit(True).alias("row"), *[docs[c].alias(f"c{i}") for i, c in enumerate(others)])
    rows = docs.select(*doc_key(id_col, text_col), rest.alias("rest"), _lines(F.col(text_col)).alias("lines"))
    # Merged at every size: the list grows with the documents, so it is never sent to each task.
    rows = rows.join(drop.hint("merge"), _KEY, "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("positions"))
    kept = F.transform(kept, lambda i: F.get(F.col("lines"), i))
    lines = F.when(F.col("positions").isNull(), F.col("lines")).otherwise(kept)
    back = {c: F.col(f"rest.c{i}") for i, c in enumerate(others)} | {text_col: F.array_join(lines, "\n")}
    return rows.select(*[back[c].alias(c) for c in docs.columns if c in back],
                       F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_deleted"))
