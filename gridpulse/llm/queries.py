"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bag_minhash, exact_dedup, feature_join, license_scan, line_dedup, lm_scoring, mixing, piece_nbest, quality_rules, spelling_variants, substring_dedup, suffix_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class and links; the passages themselves come from ``repeated_passages``."""
    return substring_dedup.document_classes(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.templates(spark))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the ids, by hash, are the snapshot; the others arrive as a batch."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cleaned(table(spark, sf_dir, "documents"), keep_text=False)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).cast("long").alias("taken"))


def op9_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_nbest.encode_digests(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.document_variants(table(spark, sf_dir, "documents"))


def op13_feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_join.label_features(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_lm_scoring, op2_line_dedup, op3_substring_dedup, op4_license_scan, op5_exact_dedup, op6_suffix_dedup, op7_quality_rules, op8_mixing, op9_bag_minhash, op10_piece_nbest, op11_toxicity, op12_spelling_variants, op13_feature_join]
    return {f.__name__: f for f in own}


#: For exact results that SQL can express. DuckDB's regular expressions know \x escapes; chr(31) cannot occur in a hash.
OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP13_SQL = """
WITH h AS (SELECT doc_id, source, n_chars, lang, sha256(doc_id::VARCHAR) AS x FROM documents),
v AS (
  SELECT *, e - 60 + ('0x' || substr(x, 9, 8))::BIGINT % 600 AS a, e + ('0x' || substr(x, 17, 8))::BIGINT % 900 AS z
  FROM (SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % 50000 AS e FROM h)),
l AS (
  SELECT row_number() OVER () AS r, labels.doc_id, source, ('0x' || substr(sha256(labels.doc_id::VARCHAR), 25, 8))::BIGINT % 50000 AS t
  FROM labels LEFT JOIN (SELECT doc_id, max(source) AS source FROM documents GROUP BY doc_id) USING (doc_id)),
b AS (
  SELECT l.r, max({'e': e, 'a': a, 'id': v.doc_id, 'n_chars': n_chars, 'lang': lang}) AS w
  FROM l JOIN v ON v.source = l.source AND e <= t AND a <= t AND t < z GROUP BY l.r)
SELECT doc_id, t, w.id AS version_id, t - w.e AS age, CASE WHEN w IS NULL THEN 'none' WHEN t - w.e > 120 THEN 'stale' ELSE 'fresh' END AS status,
  CASE WHEN t - w.e <= 120 THEN w.n_chars END AS n_chars, CASE WHEN t - w.e <= 120 THEN w.lang END AS lang
FROM l LEFT JOIN b USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op13_feature_join": OP13_SQL}
