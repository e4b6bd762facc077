"""Quality rules: a decision list learned by sequential covering, applied as Spark conditions.

Statistics of the documents are DataFrame functions. A bounded sample of
labelled rows (``sample_rows``, those with the smallest hash of their id) comes
to the driver as numbers; rules are grown there on two thirds of it by FOIL gain
and pruned on the rest, as bit sets. What results is an ordered CASE expression
of threshold conjunctions, evaluated on every document.

Defined cases: null text has no words; without usable labels the list is empty
and only the base rule decides; labels given twice count as the lowest; rows are
independent, so repeated rows repeat their result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS

SAMPLE_ROWS = 20_000
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "exclaim_share", "words_per_line")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with counts per whole text; arrays live only inside the projection."""
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("__t", text).withColumn("__w", F.filter(F.split("__t", WS), lambda x: x != ""))
    d = d.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_words", F.size("__w").cast("long"))
    # The hash of a window of three words, with its place in the low bits: one sort of longs brings equal windows together, and their words are compared.
    d = d.withColumn("__m", (F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n_words"), F.lit(2).cast("long")).cast("double")))) - 1).cast("long"))
    at = lambda i: F.get("__w", i.cast("int"))
    window = lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)).bitwiseAND(F.bitwise_not("__m")).bitwiseOR(i)
    none = F.array().cast("array<bigint>")
    d = d.withColumn("__s", F.when(F.col("n_words") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_words") - 3), window))).otherwise(none))
    word = lambda x, k: at(x.bitwiseAND(F.col("__m")) + k)
    same = lambda x, y: y.isNotNull() & (x.bitwiseXOR(y).bitwiseAND(F.bitwise_not("__m")) == 0) & (word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2))
    twice = F.filter("__s", lambda x, i: same(x, F.get("__s", i - 1)) | same(x, F.get("__s", i + 1)))
    d = d.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(F.col("__m")))))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(F.transform("__p", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("__p", i + 1) - p, F.lit(3).cast("long")))), zero, lambda a, x: a + x)
    count = lambda p: F.size(F.regexp_extract_all("__t", F.lit(p), F.lit(0))).cast("long")
    d = d.withColumns({
        "word_chars": F.aggregate("__w", zero, lambda a, x: a + F.length(x)), "n_symbols": count(r"[#*$%&|<>]"), "n_lines": F.size("__l").cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"), "n_repeat_words": covered,
        "n_upper": count("[A-Z]"), "n_digits": count("[0-9]"), "n_exclaim": count("!"),
    }).drop("__t", "__w", "__l", "__m", "__s", "__p")
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1).cast("long"))
    return d.withColumns({
        "mean_word": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"), "digit_share": share("n_digits", "word_chars"), "exclaim_share": share("n_exclaim", "n_words"), "words_per_line": share("n_words", "n_lines"),
        "base_failed": (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
    })


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def learn(rows: list[dict], bad: str = "bad", steps: int = 48, longest: int = 3, precision: float = 0.9, least: int = 3) -> list[Rule]:
    """Ordered rules, each of which names documents to reject.

    ``rows`` has the features and the flag ``bad``. A rule is kept if, after
    pruning, at least ``precision`` of what it newly covers is bad, on the
    growing and on the pruning part alike.
    """
    n = len(rows)
    if not n:
        return []
    bits = lambda flags: int("".join("1" if x else "0" for x in reversed(flags)), 2)
    flags = bits([r[bad] for r in rows])
    grow_part = bits([i % 3 for i in range(n)])
    prune_part = ((1 << n) - 1) & ~grow_part
    covers: dict[Condition, int] = {}
    for f in FEATURES:
        values = sorted({float(r[f]) for r in rows})
        cuts = sorted({(values[k] + values[k + 1]) / 2 for k in {round(q * (len(values) - 2) / steps) for q in range(steps + 1)}}) if len(values) > 1 else []
        for t in cuts:
            above = bits([r[f] > t for r in rows])
            covers[Condition(f, True, t)], covers[Condition(f, False, t)] = above, ((1 << n) - 1) & ~above

    def counts(rows_in: int) -> tuple[int, int]:
        p = (rows_in & flags).bit_count()
        return p, rows_in.bit_count() - p

    def right(p: int, q: int) -> float:
        return p / (p + q) if p + q else 0.0

    left, rules = (1 << n) - 1, []
    while counts(left & grow_part)[0] >= least:
        rule: list[Condition] = []
        inside = left
        for _ in range(longest):
            p0, q0 = counts(inside & grow_part)
            if not q0:
                break
            base = math.log2(right(p0, q0))
            best = max(covers, key=lambda c: (p := counts(inside & covers[c] & grow_part)) and (p[0] * (math.log2(right(*p)) - base) if p[0] else -1.0))
            p, q = counts(inside & covers[best] & grow_part)
            if p < least or right(p, q) <= right(p0, q0):
                break
            rule.append(best)
            inside &= covers[best]

        def reach(r: list[Condition]) -> int:
            got = left
            for c in r:
                got &= covers[c]
            return got

        while len(rule) > 1:
            worth = lambda r: (lambda p, q: (p - q) / (p + q) if p + q else -1.0)(*counts(reach(r) & prune_part))
            shorter = max((rule[:k] for k in range(1, len(rule))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        got = reach(rule)
        seen = counts(got & prune_part)
        if not rule or right(*counts(got & grow_part)) < precision or (seen[0] + seen[1] and right(*seen) < precision) or not got:
            break
        rules.append(tuple(rule))
        left &= ~got
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one CASE expression, first match first; what no rule names is kept."""
    out = None
    for rule in rules:
        both = rule[0].column()
        for c in rule[1:]:
            both = both & c.column()
        out = F.when(both, F.lit(False)) if out is None else out.when(both, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from at most ``sample_rows`` labelled documents that pass the base rule."""
    named = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__q"))
    named = named.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    body = docs.select("doc_id", "text").join(F.broadcast(named), F.col("doc_id") == F.col("__id"))
    rows = statistics(body).select("doc_id", "base_failed", *FEATURES, (F.col("__q") == 0).alias("bad")).collect()
    return learn([r.asDict() for r in sorted(rows, key=lambda r: r["doc_id"]) if not r["base_failed"]])


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics and ``kept``.

    The id in the condition always holds; it keeps a filter on ``kept`` above the
    projections, where pushing it down would nest the array expressions.
    """
    return statistics(docs).withColumn("kept", F.when(F.monotonically_increasing_id() >= 0, ~F.col("base_failed") & verdict(rules)))


def filter_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents that pass the base rule and the learned list, with their own columns alone."""
    held = docs.select(F.struct("*").alias("__row"), "doc_id", "text")
    return judge(held, fit(docs, labels, sample_rows)).where("kept").select("__row.*")
