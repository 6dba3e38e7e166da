"""The queries over this subpackage's operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import ann, chat, decontam, language, neardup, packing, quality, toxicity, url_filter, warc
from fieldloom.llm.common import fold, labelled_sample, table

URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, folds: int, held: int) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.character_model(docs)
    judge = toxicity.train(docs, labelled_sample(labels, "toxic", fold(F.col("doc_id"), 4) != 2, toxicity.MOST), model)
    return _judged(toxicity.score(docs, model, judge), 4, 2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors = quality.word_vectors(docs)
    network = quality.train(docs, labelled_sample(labels, "quality", fold(F.col("doc_id"), 5) != 0, quality.MOST), vectors)
    return _judged(quality.score(docs, vectors, network), 5, 0)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs, fold(F.col("doc_id"), 4) != 2))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(found).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_url_filter": op3_url_filter,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
}

_RULES = ", ".join(f"('{action}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for action, rule in URL_RULES)
URL_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(action, rule, rhost, rpath) AS (VALUES {_RULES}),
m AS (
  SELECT h.page_id, h.host, h.path, r.rule, r.action,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS rn
  FROM h LEFT JOIN r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE rn = 1
"""

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CHARS = " || ".join(f"substr('{_B32}', 1 + ((CAST('0x' || substr(h, {5 * j + 1}, 5) AS BIGINT) >> {15 - 5 * i}) & 31)::INTEGER, 1)" for j in range(8) for i in range(4))
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS h FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_CHARS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

ORACLE_SQL = {"op3_url_filter": URL_SQL, "op4_chat_rotation": chat.ROTATE_SQL, "op10_warc": WARC_SQL}
