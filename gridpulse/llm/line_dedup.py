"""Fuzzy line deduplication with DataFrame functions alone.

A line is a piece of text between line feeds, trimmed of white space; blank
lines are left alone. Lines are known by a 128-bit hash of their content, so equal
lines are one before any comparison. Signatures and verification take the same set:
every five characters of the lower-cased line.

Shingles are cut from a fixed-width encoding and hashed; the distinct hashes, sorted,
are the line's shingles in a random order. Each of ``parts`` equal parts of the hash
space gives a band: the ``rows`` least hashes from the part's beginning on (going on
into the next parts, and from the end to the beginning, where there are fewer). Two
lines agree on a band if the ``rows`` least shingles of their union from there on
belong to both, which has probability J ** rows as for ``rows`` minima: with 10
bands of 6 a pair meets with probability 0.95 at J = 0.8 and 0.99 at 0.85. Lines of
many shingles take bands of a quarter of them, chosen by hash, and lines of few
take shorter bands; the kind goes by the number of distinct shingles, and lines near a
limit take both kinds, so similar lines share one whatever their lengths. ``rows``
grows by one with each tenfold of documents beyond ``BASE_DOCS`` (counted first), and
the bands with it, because chance meetings grow with the square of the lines.

``class_roots`` compares within buckets by exact Jaccard similarity and contracts the
links by a distributed union-find, and one line of each component stays: the first by
``doc_id`` and line number. Recall at similarity 0.8 is held against brute force in
the tests.

Defined cases: null text is empty and has no lines; ``doc_id`` is the key (rows
repeated in full share decisions, rows with a null ``doc_id`` are left as they
are); extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import class_roots, cut, release, small, texts

SIMILARITY = 0.8
#: Rows of a band, up to so many documents.
ROWS, BASE_DOCS = 6, 1_000_000
#: Bands miss a pair at similarity 0.8 with about this probability.
MISS = 0.05
#: One in so many shingles is sampled; a line with MANY sampled ones or more takes bands of them, one with fewer than SOME of all.
SAMPLED, MANY, SOME = 4, 32, 50
#: Rows of a band of a line with fewer than FEW distinct shingles; with LESS or more it takes long ones.
FEW_ROWS, FEW, LESS = 4, 80, 64
WIDTH = 5


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line, h1, h2`` of the lines that are not blank.

    Here and below the outer form of explode spares a filter on the array that would compute it twice.
    """
    cut_up = texts(docs).where("doc_id is not null").select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    line = cut_up.withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\x0c"))).where("line <> ''")
    return line.select("doc_id", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def shingles(line: Column) -> Column:
    """Hashes of the shingles; a shorter line is its own. Four bytes a character let each be cut out in one step."""
    wide = F.array(F.encode(F.lower(line), "UTF-32"))
    return F.get(F.transform(wide, lambda b: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(b) - 4 * WIDTH + 1), F.lit(4)), lambda i: F.xxhash64(F.substring(b, i, F.lit(4 * WIDTH))))), F.lit(0))


def distinct(hashes: Column) -> Column:
    return F.sort_array(F.array_distinct(hashes))


def settings(docs: int) -> tuple[int, int]:
    """Rows and number of bands for so many documents."""
    rows = ROWS + max(0, math.ceil(math.log10(max(docs, 1) / BASE_DOCS)))
    return rows, math.floor(math.log(MISS) / math.log(1 - SIMILARITY**rows))


def bands(found: DataFrame, rows: int, parts: int) -> DataFrame:
    """``key, id`` of ``id, line``."""
    each = found.select("id", shingles(F.col("line")).alias("x"))
    each = each.select("id", "x", distinct(F.filter("x", lambda x: x.bitwiseAND(F.lit(SAMPLED - 1)) == 0)).alias("few"))
    both = F.array(F.when(F.size("few") >= MANY, F.col("few")), F.when(F.size("few") < SOME, distinct(F.col("x"))))
    each = each.select("id", F.posexplode_outer(both).alias("kind", "a"))
    each = each.select("id", "kind", "a", F.size("a").alias("n"))
    each = each.select("id", "kind", "a", "n", F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1))).alias("i"))
    part = lambda i: F.shiftrightunsigned(F.shiftrightunsigned(F.get("a", i), 32) * parts, 32)
    # In the order of signed numbers; a band begins at the first hash of its part, and a part without one shares the next one's.
    each = each.where((F.col("i") == 0) | (part(F.col("i")) != part(F.col("i") - 1)))
    key = lambda k: F.xxhash64(F.lit(k), "kind", *(F.get("a", F.pmod(F.col("i") + r, F.col("n"))) for r in range(k)))
    long = (F.col("kind") == 0) | (F.col("n") >= LESS)
    keys = F.array(F.when(long, key(rows)), F.when((F.col("kind") == 1) & (F.col("n") < FEW), key(FEW_ROWS)))
    return each.select("id", F.explode_outer(keys).alias("key")).where("key is not null")


def contents(docs: DataFrame):
    """``id, s``: one line for each hash. Of unlike lines with equal ``h1`` only the one with the least ``h2`` is compared."""

    def run(ids: DataFrame) -> DataFrame:
        ids = cut(ids.withColumnRenamed("id", "h1"), "line-ids")
        body = lines(docs).join(small(ids), "h1", "left_semi").groupBy("h1").agg(F.min_by("line", "h2").alias("s"))
        return body.withColumnRenamed("h1", "id")

    return run


def line_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per line that is not blank: ``doc_id, line_no, keep_doc_id, keep_line_no, kept``."""
    rows, parts = settings(docs.count())
    every = lines(docs)
    buckets = bands(every.select(F.col("h1").alias("id"), "line"), rows, parts)
    buckets = cut(buckets, "line-bands")
    every = cut(every.drop("line"), "line-hashes")
    roots = class_roots(buckets, contents(docs), similarity, expand=lambda line: distinct(shingles(line)))
    release(buckets)
    own = F.struct("doc_id", "line_no")
    # 2**32 lines a document at most; a decimal keeps the minimum in the hash aggregate.
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("line_no").cast("decimal(11,0)")
    first = every.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("copies"))
    roots = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    # Of unlike lines with equal h1 the one compared carries the class.
    roots = every.groupBy("h1").agg(F.min("h2").alias("h2")).join(roots, F.col("h1") == F.col("node")).select("h1", "h2", "root")
    first = first.join(roots, ["h1", "h2"], "left").where("copies > 1 or root is not null").select("h1", "h2", "place", F.col("root").alias("class"))
    first = cut(first, "many")
    least = first.where("class is not null").groupBy("class").agg(F.min("place").alias("low"))
    first = first.join(least, "class", "left").select("h1", "h2", F.coalesce("low", "place").alias("low"))
    keep = F.floor(F.col("low") / F.lit(1 << 32).cast("decimal(11,0)")).cast("long")
    number = (F.col("low") - keep.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")).cast("int")
    first = first.select("h1", "h2", F.struct(keep.alias("doc_id"), number.alias("line_no")).alias("root"))
    out = every.join(first, ["h1", "h2"], "left").select("doc_id", "line_no", F.coalesce("root", own).alias("root"))
    return out.select("doc_id", "line_no", F.col("root.doc_id").alias("keep_doc_id"), F.col("root.line_no").alias("keep_line_no"), (F.col("root") == own).alias("kept"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one line of each component; ``n_chars``, where there is one, is counted again.

    A document that had words and has none left goes.
    """
    gone = line_classes(docs, similarity).where("not kept").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("line_no").alias("__gone"))
    out = docs.join(gone, docs.doc_id == F.col("__id"), "left")
    drop = F.map_from_arrays("__gone", "__gone")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.map_contains_key(drop, i))
    out = out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    out = out.where("__gone is null or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").drop("__id", "__gone")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
