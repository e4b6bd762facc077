"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the form each belongs to.

Forward and reversed dictionaries: one edit leaves the first or the last half of a word
intact, so two near words stand in one range of the forward dictionary (same first half)
or of the reversed one (same last half). A range is a block; a sort-merge join scans the
blocks and verifies with the edit distance, so only near pairs come out.

A block is a set of words of ``s`` or ``s + 1`` code points that agree before place ``i``
and after place ``j`` of the shorter word; the edit lies between. A block of more than
``block`` words is halved by the same argument: either the first half of what lies
between is intact or the last. Halving ends at one place, where a block has at most as
many words as there are letters, and pairs of letters, so no word is dropped and no
block grows with the corpus. A pair found in several blocks is kept once.

Null texts have no words; rows with one id and repeated rows each count. A null id counts as
empty text where it is hashed. Texts without runs and empty tables give no rows. Extra
columns are not looked at. Very long runs are words like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, is_empty, swap

#: Maximal runs of letters; a run too short to be a word is not taken at all.
LETTERS = r"([A-Za-zÀ-ÿ]{%d,})"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A form has at least so many times the occurrences of its variant.
RATIO = 5
#: One occurrence in so many, by hash, loses a code point.
TYPO = 199


def with_typos(docs: DataFrame, shortest: int) -> DataFrame:
    """``word``, one row an occurrence: lower-cased runs, of which some by hash lose a code point."""
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LETTERS % shortest), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, UPPER.lower()))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % TYPO == 0, short).otherwise(F.col("run")).alias("word"))


def dictionary(occurrences: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """``word, n`` of words with at least ``shortest`` code points and ``least`` occurrences."""
    return occurrences.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def placed(members: DataFrame) -> DataFrame:
    """``members`` (``word, s, i, j``) with ``stem``, what the words of a block have in common."""
    stem = F.concat(F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("j") + 1 + F.length("word") - F.col("s"), F.col("s") - F.col("j")))
    return members.select("word", "s", "i", "j", stem.alias("stem"))


def halves(members: DataFrame) -> DataFrame:
    """Each member in the two blocks that halving its block makes."""
    half = F.floor((F.col("j") - F.col("i")) / 2).cast("int")
    two = F.array(F.struct((F.col("i") + half).alias("i"), F.col("j").alias("j")), F.struct(F.col("i").alias("i"), (F.col("i") + half).alias("j")))
    return placed(members.select("word", "s", F.inline(two)))


BLOCK = ["s", "i", "j", "stem"]


def near_pairs(words: DataFrame, block: int = 48) -> DataFrame:
    """``a, b``: all unordered pairs of distinct ``word``s at edit distance one, each once."""
    length = F.length("word")
    whole = words.select("word", F.explode(F.array(length, length - 1)).alias("s")).where("s > 0").select("word", "s", F.lit(0).alias("i"), F.col("s").alias("j"))
    members, closed = halves(whole), None
    short = F.length("word") == F.col("s")
    while True:
        sizes = members.groupBy(*BLOCK).agg(F.count("*").alias("size"), F.count(F.when(short, 1)).alias("shorter")).where("shorter > 0 and size > 1")
        members = cut(members.join(sizes.drop("shorter"), BLOCK), "blocks")
        done = (F.col("size") <= block) | (F.col("j") - F.col("i") <= 1)
        small = members.where(done).drop("size")
        closed = small if closed is None else closed.union(small)
        if is_empty(members.where(~done)):
            break
        members = halves(members.where(~done))
    a = closed.where(short).withColumnRenamed("word", "a")
    b = closed.withColumnRenamed("word", "b").hint("merge")
    same = (F.length("b") > F.col("s")) | (F.col("a") < F.col("b"))
    pairs = a.join(b, BLOCK).where(same & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(forms: DataFrame, most: int, ratio: int = RATIO) -> DataFrame:
    """``word, root`` at the end of the chains of ``word, form``; counts grow by ``ratio`` at each step, up to ``most``."""
    to = cut(forms.select("word", F.col("form").alias("root")), "forms")
    steps = max(1, math.ceil(math.log(max(most, ratio), ratio)))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        next_ = to.select(F.col("word").alias("root"), F.col("root").alias("far"))
        to = swap(to, to.join(next_, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
    return to


def variants(words: DataFrame, ratio: int = RATIO, block: int = 48) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a dictionary ``word, n``.

    The form is the near word with the most occurrences, the smallest by code point on
    ties, if it has at least ``ratio`` times the word's; the root is the end of the
    chain of forms, the word itself if it has none.
    """
    words = cut(words.select("word", "n"), "words")
    pairs = near_pairs(words, block)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.*")
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    best = best.join(words, "word")
    is_form: Column = -F.col("best.n") >= ratio * F.col("n")
    best = cut(best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "near")
    most = words.agg(F.max("n")).first()[0] or 0
    ends = roots(best.where("form is not null"), most, ratio)
    out = words.join(best, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of whole documents."""
    return variants(dictionary(with_typos(docs, 6)))
