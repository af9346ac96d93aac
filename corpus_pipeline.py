"""The corpus pipeline: five stages over ``documents``, each stored before the next.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns
the columns of ``documents``; the last returns the token ids.  ``n_chars`` follows the text.

1. ``language``: texts without a recognisable language go (no letter, or a tie); ``lang``
   is filled where it is null.  The dictionaries are fitted on the stage's labelled rows.
2. ``lines``: later copies of line runs of 50 words or more are deleted; a document whose text
   becomes empty by that goes.
3. ``near_duplicates``: one document of each group stays (five-word shingles, 0.8).
4. ``benchmark``: contaminated documents go.
5. ``tokens``: ids, decoded back and compared with the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm import byte_bpe, decontaminate, langid, line_dedup, lsh_forest
from tradelens.llm.common import documents, stored

#: Language ID, near-duplicate detection and tokenizing have no SQL form; the stages are tested
#: against brute-force versions instead.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(langid.training_sample(docs))
    # The input's columns travel in a struct, where no name clashes.
    rows = docs.select(F.struct("*").alias("row"), langid.predict(F.col("text"), model).alias("p"))
    lang = F.coalesce(F.col("row.lang"), F.col("p.lang_pred"))
    return rows.where(~F.col("p.rejected")).select(
        *[(lang if c == "lang" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    done = line_dedup.dedup_lines(docs.select("doc_id", "text", others, F.col("text").rlike("\\S").alias("had_text")))
    emptied = F.col("had_text") & (F.col("n_deleted") > 0) & ~F.col("text").rlike("\\S")
    done = done.where(~F.coalesce(emptied, F.lit(False)))
    n_chars = F.when(F.col("n_deleted") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))
    rows = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("text"), "n_chars": n_chars}
    return done.select(*[rows[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lsh_forest.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = docs.select("doc_id", "lang", "source",
                        byte_bpe.bpe_checked_ids(F.col("text"), ranks, public_tokenizers.PATTERN).alias("c"))
    return coded.select("doc_id", "lang", "source", F.size("c.ids").cast("long").alias("n_tokens"), "c.ids", "c.round_trip")


#: Whole texts are written beside Python workers: small row groups keep the writers' buffers small.
ROW_GROUPS = {"parquet.block.size": 16 * 1024 * 1024}

STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("benchmark", benchmark), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", **ROW_GROUPS)
    return STAGES[-1][1](spark, docs, sf_dir)
