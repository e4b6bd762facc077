"""Point-in-time feature join: the version of a source that is known and valid when a label asks.

Active-rank bitset sweep: time is cut into chunks; in each chunk of a source the
versions are ranked by winning order, a version's bit is set at its start and cleared
at its expiry, and a question is answered by the highest bit that is set.

* A version is usable at ``t`` if ``event <= t`` and ``arrival <= t < expiry``. The latest
  event wins, then the latest arrival, then the largest id, then the larger payload.
* Versions that agree in source and times are folded to the winning one before the
  shuffle, and a source's questions at one time are asked once.
* A version reaches the first and the last chunk of its life as a row; whole chunks
  between them are covered by dyadic spans, of which only the best version each is kept,
  so a version without an expiry costs some forty rows, not one a chunk.
* A chunk with more than ``per_task`` versions is split by hash; each part answers all
  questions of the chunk, and the best answer stays. No chunk meets in one task.

Null sources, events or arrivals are never usable; a null expiry never comes; a question
without source or time has no answer. Repeated versions and questions change nothing.
Empty tables give no answers. Extra columns are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dyadic spans reach so many levels above a chunk, and a version that never expires ends there.
LEVELS = 40
#: Bits in one word of the set.
WORD = 512

KEYS = ["event", "arrival", "id"]


class ActiveRanks:
    """A set of ranks with the greatest one at hand: words of bits, and one bit a word that is not empty."""

    def __init__(self, n: int) -> None:
        self.words, self.full = [0] * (n // WORD + 1), 0

    def toggle(self, rank: int) -> None:
        w, bit = divmod(rank, WORD)
        was = self.words[w]
        self.words[w] = now = was ^ (1 << bit)
        if not was or not now:
            self.full ^= 1 << w

    def top(self) -> int:
        """The greatest rank, -1 for the empty set."""
        if not self.full:
            return -1
        w = self.full.bit_length() - 1
        return w * WORD + self.words[w].bit_length() - 1


def sweep(lo: list[int], hi: list[int], asked: list[int]) -> list[int]:
    """For each time of ``asked`` the greatest index i with ``lo[i] <= t < hi[i]``, or -1."""
    turns = sorted([(t, i) for i, t in enumerate(lo)] + [(t, i) for i, t in enumerate(hi)])
    active, k, out = ActiveRanks(len(lo)), 0, [-1] * len(asked)
    for j in sorted(range(len(asked)), key=asked.__getitem__):
        while k < len(turns) and turns[k][0] <= asked[j]:
            active.toggle(turns[k][1])
            k += 1
        out[j] = active.top()
    return out


def spans(first: Column, end: Column) -> Column:
    """The dyadic spans ``level, node`` that make up the chunks from ``first`` to before ``end``."""
    found = []
    for k in range(LEVELS):
        size = F.lit(1 << k).cast("long")
        a = F.floor((first + size - 1) / size) if k == 0 else F.shiftright(first + size - 1, k)
        b = F.shiftright(end, k)
        for node, odd in ((a, a), (b - 1, b)):
            found.append(F.when((a < b) & (odd.bitwiseAND(F.lit(1)) == 1), F.struct(F.lit(k).alias("level"), node.cast("long").alias("node"))))
    return F.array_compact(F.array(*found))


def winners(versions: DataFrame, asked: DataFrame, payload: list[str], width: int = 1024, per_task: int = 20_000) -> DataFrame:
    """The winning version of each distinct ``source, t`` of ``asked`` that has one: ``source, t, event, arrival, id`` and ``payload``.

    ``versions`` has ``source, event, arrival, expiry, id`` and the columns ``payload``;
    times are whole numbers, of which ``width`` make a chunk.
    """
    row = F.struct(*KEYS, *payload)
    floor = lambda c: F.floor(c / F.lit(width)).cast("long")
    v = versions.where("source is not null and event is not null and arrival is not null")
    v = v.groupBy("source", "event", "arrival", "expiry").agg(F.max(row).alias("v"))
    v = v.select("source", "v", F.greatest("event", "arrival").alias("lo"), F.coalesce("expiry", F.lit(width << (LEVELS - 1)).cast("long")).alias("hi")).where("lo < hi")
    v = v.withColumn("c0", floor(F.col("lo"))).withColumn("c1", floor(F.col("hi") - 1))
    ends = v.select("source", F.explode(F.array_distinct(F.array("c0", "c1"))).alias("chunk"), "lo", "hi", "v")
    questions = asked.where("source is not null and t is not null").select("source", "t").distinct().withColumn("chunk", floor(F.col("t")))

    whole = v.where("c1 - c0 > 1").select("source", "v", F.explode(spans(F.col("c0") + 1, F.col("c1"))).alias("s"))
    whole = whole.groupBy("source", "s.level", "s.node").agg(F.max("v").alias("v"))
    above = questions.select("source", "chunk").distinct().select("source", "chunk", F.posexplode(F.array(*(F.shiftright("chunk", k) for k in range(LEVELS)))).alias("level", "node"))
    cover = above.join(whole.hint("merge"), ["source", "level", "node"]).groupBy("source", "chunk").agg(F.max("v").alias("v"))
    start = F.col("chunk") * width
    members = ends.union(cover.select("source", "chunk", start.alias("lo"), (start + width).alias("hi"), "v"))

    hot = members.groupBy("source", "chunk").agg(F.ceil(F.count("*") / F.lit(per_task)).cast("int").alias("parts"))
    members = members.join(hot.hint("merge"), ["source", "chunk"]).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    questions = questions.join(hot.hint("merge"), ["source", "chunk"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["source", "chunk", "part"]
    kept = [*KEYS, *payload]
    rows = members.select(*keys, "lo", "hi", F.lit(None).cast("long").alias("t"), *(F.col(f"v.{c}").alias(c) for c in kept))
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    rows = rows.union(questions.select(*keys, none("lo"), none("hi"), "t", *(none(c) for c in kept)))

    def answer(table: pa.Table) -> pa.Table:
        known, open_ = table.filter(pc.is_valid(table["lo"])), table.filter(pc.is_valid(table["t"]))
        known = known.take(pc.sort_indices(known, sort_keys=[(c, "ascending") for c in kept], null_placement="at_start"))
        best = sweep(known["lo"].to_pylist(), known["hi"].to_pylist(), open_["t"].to_pylist())
        at = pa.array([i if i >= 0 else None for i in best], pa.int64())
        out = pa.table({"source": open_["source"], "t": open_["t"]} | {c: known[c].take(at) for c in kept})
        return out.filter(pc.is_valid(at))

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("source", "t", *kept))
    best = rows.groupBy(*keys).applyInArrow(answer, schema)
    return best.groupBy("source", "t").agg(F.max(row).alias("v")).select("source", "t", "v.*")


def eight(n: int) -> Column:
    """The n-th eight digits of the hexadecimal sha256 of the decimal ``doc_id``, as a number."""
    return F.conv(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1 + 8 * n, 8), 16, 10).cast("long")


def document_versions(docs: DataFrame) -> DataFrame:
    """Each document as a version of its source, with times from the hash of its id."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "n_chars", "lang").withColumn("event", F.pmod(eight(0), F.lit(50_000)))
    return d.select("source", "event", (F.col("event") - 60 + F.pmod(eight(1), F.lit(600))).alias("arrival"), (F.col("event") + F.pmod(eight(2), F.lit(900))).alias("expiry"), F.col("doc_id").alias("id"), "n_chars", "lang")


def label_features(docs: DataFrame, labels: DataFrame, stale: int = 120, **sizes: int) -> DataFrame:
    """Per row of ``labels``: ``doc_id, t, version_id, age, status, n_chars, lang``; both features only of a fresh version.

    A label asks about the source of its document, of the greatest one by code point if
    rows with its id disagree; one without a document, source or id has status ``none``.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source").where("doc_id is not null").groupBy("doc_id").agg(F.max("source").alias("source"))
    asked = ids.join(own.hint("merge"), "doc_id", "left").withColumn("t", F.pmod(eight(3), F.lit(50_000)))
    best = winners(document_versions(docs), asked, ["n_chars", "lang"], **sizes)
    out = asked.join(best.hint("merge"), ["source", "t"], "left")
    age = F.col("t") - F.col("event")
    out = out.withColumn("age", age).withColumn("status", F.when(F.col("id").isNull(), "none").when(age > stale, "stale").otherwise("fresh"))
    fresh = lambda c: F.when(F.col("status") == "fresh", F.col(c)).alias(c)
    return out.select("doc_id", "t", F.col("id").alias("version_id"), "age", "status", fresh("n_chars"), fresh("lang"))
