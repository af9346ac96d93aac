"""The registered queries of the training-data operators: thin digests of their outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitplane as BIT
from . import byte_bpe as BP
from . import cover_tree as CT
from . import decontaminate as DC
from . import hard_negatives as HN
from . import heap_bpe as HB
from . import langid as LI
from . import line_dedup as LN
from . import lsh_forest as LF
from . import pii as PI
from . import prefix_trie as PT
from . import toxicity as TX
from . import warc as WA
from .common import crc32_mod, doc_key, documents, new_folder, ship_package

#: The id appended to every document in the token files.
END_ID = 2


def q_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    return CT.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def fit_languages(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the labelled rows outside the held-out fold."""
    return LI.fit(LI.training_sample(docs.where(crc32_mod("doc_id", 4) != 2)))


def q_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    done = docs.select("doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"),
                       LI.predict(F.col("text"), fit_languages(docs)).alias("p"))
    return done.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.margin", "p.rejected")


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LN.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Digest of ``decontaminate.overlaps``: one row per row of ``docs``."""
    done = DC.overlaps(docs, items).select(
        "k1", "k2", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        DC.contaminated().alias("contaminated"))
    rows = docs.select("doc_id", *doc_key("doc_id", "text"))
    return rows.join(done, ["k1", "k2"]).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def bpe_ranks() -> bytes:
    return BP.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = BP.bpe_round_trip(F.col("text"), bpe_ranks(), public_tokenizers.PATTERN)
    return documents(spark, sf_dir).select("doc_id", digest.alias("d")).select("doc_id", "d.*")


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LF.near_duplicates(documents(spark, sf_dir), width=2).drop("k1", "k2")


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> dict:
    """The classifier from the labelled rows outside the held-out fold."""
    return TX.fit(TX.training_rows(docs, labels.where(crc32_mod("doc_id", 3) != 1)))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, documents(spark, sf_dir, "labels"))
    done = docs.select("doc_id", (crc32_mod("doc_id", 3) == 1).alias("held_out"),
                       TX.toxicity(F.col("text"), model).alias("score"))
    return done.withColumn("predicted", (F.col("score") >= TX.THRESHOLD).cast("int"))


def personal_data(docs: DataFrame, model: dict) -> DataFrame:
    """Digest of ``pii.personal_spans``: one row per row of ``docs``."""
    found = docs.select("doc_id", PI.personal_spans(F.col("text"), model).alias("p")).select("doc_id", "p.*")

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in PI.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return personal_data(docs, PI.fit(PI.training_rows(docs)))


def token_planes(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the documents' token files and read them back."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    folder = new_folder(spark, "token-planes")
    written = BIT.write_planes(docs, folder, vocabulary, END_ID, **options)
    read = BIT.read_planes(BIT.open_planes(spark, folder))
    return BIT.document_ranges(written, read).withColumnRenamed("id", "doc_id")


def q_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As the library codes a text by default.
    return token_planes(spark, documents(spark, sf_dir), special=True)


def warc_digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages' archives and read them back."""
    folder = new_folder(spark, "warc")
    WA.write_archives(pages, folder)
    return WA.read_archives(WA.open_archives(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_digest(spark, documents(spark, sf_dir, "pages"))


def q_heap_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = HB.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    digest = HB.heap_round_trip(F.col("text"), vocabulary)
    return documents(spark, sf_dir).select("doc_id", digest.alias("d")).select("doc_id", "d.*")


def q_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PT.prefix_trie(PT.shared_heads(PT.paths(documents(spark, sf_dir, "conversations"))))


def relabelled(vectors: DataFrame) -> DataFrame:
    """``vectors`` with the labels of ids divisible by 7 moved on by one, modulo 10."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = relabelled(documents(spark, sf_dir, "embeddings"))
    return HN.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cover_tree": q_top_k,
    "op2_language_id": q_langid,
    "op3_line_dedup": q_line_dedup,
    "op4_decontaminate": q_decontaminate,
    "op5_byte_bpe": q_byte_bpe,
    "op6_lsh_forest": q_near_duplicates,
    "op7_toxicity": q_toxicity,
    "op8_pii": q_pii,
    "op9_bitplane": q_token_planes,
    "op10_warc": q_warc,
    "op11_heap_bpe": q_heap_bpe,
    "op12_prefix_trie": q_prefix_trie,
    "op13_hard_negatives": q_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_cover_tree": """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok q JOIN ok r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id AND len(r.v) = len(q.v)),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op4_decontaminate": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM item WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
met AS (SELECT g.doc_id, g.p, g.n, x.item_id FROM grams g JOIN windows x ON x.n = g.n AND x.words = g.words),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n >= 1000 AND latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND latest <> page_id THEN latest END AS refers_to
FROM p""",
    # CRC-32 bit by bit: no function of that name.
    "op12_prefix_trie": r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, turn, md5(CAST(strlen(r) AS VARCHAR) || ':' || r || x) AS digest,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words FROM raw),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i FROM turns),
convs AS (
  SELECT conv_id, xor(list_reduce(
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
             lambda v, z: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, byte)), 4294967295), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM raw)),
joined AS (
  SELECT c.conv_id, 0 AS part, i, digest, words
  FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 20 AND n.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, i, digest, words FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.i > c.h),
steps AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d FROM joined),
members AS (
  SELECT conv_id, d, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, words FROM steps
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs),
sizes AS (SELECT conv_id, max(d) AS size FROM members GROUP BY conv_id),
nodes AS (
  SELECT path, d, left(path, 32 * greatest(d - 1, 0)) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = size), '')) AS ends_sha256
  FROM members JOIN sizes USING (conv_id) GROUP BY path, d),
kids AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
below AS (
  SELECT left(path, 32 * unnest(range(0, d + 1))) AS path, n_children, (n_convs - 1) * words AS saved FROM full_nodes),
sums AS (SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved FROM below GROUP BY path)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, CASE WHEN n.d > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs, n.n_children,
       s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (path) JOIN nodes p ON p.path = n.parent""",
    "op13_hard_negatives": """
WITH ok AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok a JOIN ok r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id AND len(r.v) = len(a.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5""",
}

ship_package()
