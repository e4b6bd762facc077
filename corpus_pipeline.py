"""The corpus pipeline: quality rules, line deduplication, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame that is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm import bag_minhash, line_dedup, mixing, piece_nbest, quality_rules
from gridpulse.llm.common import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with ``scores`` and ``pieces`` of the n best segmentations."""
    return piece_nbest.encode(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("mixing sources", mix), ("SentencePiece encoding", encode)]

#: No SQL expresses the learned rules, MinHash, hash-seeded coins or the search; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{k}")
    return docs
