"""Mixing sources to target weights with DataFrame functions alone.

Tokens are summed by source; targets follow from weights and caps; a source's
repetition rate is its target by its size. A document appears floor(rate) times
and once more if a coin hashed from it and the seed falls below the fraction.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; rows repeated in full toss the same coin; a source without a word has
target 0; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, WS, cut

WEIGHTS, CAP, SEED = (1, 2, 3), 3, 20240613


def word_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), WS)
    blank = lambda i: F.when(F.element_at(parts, i) == "", 1).otherwise(0)
    return (F.size(parts) - F.when(F.size(parts) == 1, blank(1)).otherwise(blank(1) + blank(-1))).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in order of ``source``, nulls last, without one task that sees all sources."""
    order = F.col("source").asc_nulls_last()
    part = cut(sources.repartitionByRange(order).withColumn("p", F.spark_partition_id()), "sources")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offset = part.groupBy("p").agg(F.count("*").alias("n")).select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return part.join(F.broadcast(offset), "p").withColumn("rank", F.col("offset") + F.row_number().over(Window.partitionBy("p").orderBy(order)) - 1).drop("p", "offset")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size`` with ``target``: shares by weight, at most ``cap`` times the size.

    What a cap turns away is shared again by weight. Each pass is one sum over
    the sources; a source once capped stays so, and passes end when none joins.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = cut(ranked(sources).select("source", "source_size", w.alias("w"), (F.col("source_size") * cap).cast("double").alias("most")), "weighed")
    level = -1.0
    while True:
        full = F.col("most") <= F.col("w") * F.lit(level)
        total, capped, open_w = table.agg(F.sum("source_size"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w")))).first()
        now = ((total or 0) - (capped or 0.0)) / open_w if open_w else level
        if now <= level:
            break
        level = now
    return table.select("source", "source_size", F.least("most", F.col("w") * F.lit(max(level, 0.0))).alias("target"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__size, __source_size, __target, __copies``."""
    named = docs.withColumn("__size", word_count(F.col("text"))).withColumn("__null", F.col("source").isNull()).withColumn("__key", F.coalesce(F.col("source").cast("string"), F.lit("")))
    sums = named.groupBy(F.when(~F.col("__null"), F.col("__key")).alias("source")).agg(F.sum("__size").alias("source_size"))
    plan = cut(targets(sums, weights, cap), "targets")
    plan = plan.select(F.col("source").isNull().alias("__null"), F.coalesce("source", F.lit("")).alias("__key"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    if plan.count() <= BROADCAST_IDS:
        plan = F.broadcast(plan)
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    coin = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    taken = F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)
    return named.join(plan, ["__null", "__key"]).withColumn("__copies", taken).drop("__null", "__key")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    out = copies(docs, weights, cap, seed).where("__copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*(F.col(f"`{c}`") for c in docs.columns))
