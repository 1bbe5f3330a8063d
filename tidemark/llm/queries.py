"""The numbered queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, html, langid, lines, mixing, negatives, periods, pii, quality, repeats, simhash, tokens, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    """The vocabulary's file; TOKENIZER names another place."""
    import public_tokenizers

    return os.environ.get("TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept texts stand in the result as their length and hash."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "removed", F.length("kept_text").cast("long").alias("kept_chars"), F.md5("kept_text").alias("kept_md5"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(table(spark, sf_dir, "documents"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents whose id asks for it are read with repeated words."""
    return periods.find_runs(table(spark, sf_dir, "documents"), plant=True)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_source_mixing, op2_line_dedup, op3_url_filter, op4_repeated_strings, op5_token_output, op6_decontamination, op7_html_text, op8_simhash_dedup, op9_language_id, op10_quality_rules, op11_personal_data, op12_periodic_runs, op13_hard_negatives]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": OP3, "op13_hard_negatives": OP13}


OP3 = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
best AS (
  SELECT p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""

OP13 = """
WITH item AS (
  SELECT row_number() OVER () AS u, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.u, a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM item a JOIN item b ON a.u <> b.u WHERE a.id % 50 = 0),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY u ORDER BY score DESC, id NULLS LAST) <= 5),
negative AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.u, p.id ORDER BY n.score DESC, n.id NULLS LAST) AS rank
  FROM positive p JOIN scored n ON p.u = n.u AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""
