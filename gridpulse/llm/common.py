"""Shared plumbing: lineage cuts, connected components and the links of candidate buckets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

#: White space that separates words: blank and the bytes 9 to 13.
WS = r"[\x20\x09-\x0D]+"
#: Wide rows cross to Python in batches of this many.
ARROW_ROWS = 256

#: At most so many edges are contracted in one task, which spares a round its shuffles; beyond, rounds shuffle.
ONE_TASK_EDGES = 200_000

#: At most so many ids or keys are broadcast to thin out a larger table; beyond, a shuffled semi-join does it.
BROADCAST_IDS = 1_000_000

_own_root: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode, where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_root:
        _own_root.append("file://" + tempfile.mkdtemp(prefix="gridpulse-"))
    return _own_root[0]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    Lost executors then cost a re-read, not the whole lineage.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Remove the files of cuts that nothing reads any more."""
    for df in cuts:
        if path := getattr(df, "_cut_path", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def swap(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``new``, made from the cut ``old``, as a cut; the files of ``old`` go."""
    new = cut(new, name)
    release(old)
    return new


def small(df: DataFrame) -> DataFrame:
    """A cut, marked for broadcast if a count finds few rows in it."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def narrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` alone, null texts as empty; other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges as ``node, root`` (root: the smallest node).

    Alternating large-star and small-star contraction: every step is a grouped
    minimum (combined before the shuffle) and one equi-join that skew handling
    can split, so neither a hub nor a component meets in one task, unless all edges
    are few (counted first). Edges are written to the shared folder after each round.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut(e, "edges")
    n = e.count()
    # In one partition, groups and joins need no shuffle.
    held = (lambda df: df.coalesce(1)) if n <= ONE_TASK_EDGES else (lambda df: df)
    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    while n and not is_empty(unsettled(held(e))):
        both = held(e).select(F.inline(F.array(pair("u", "v"), pair("v", "u"))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tight = large.join(low, "u").select(F.inline(F.array(pair("v", "m"), pair("u", "m")))).where("u <> v").distinct()
        e = swap(e, tight, "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def unsettled(e: DataFrame) -> DataFrame:
    """Nodes that keep edges ``u, v`` (u > v) from being stars: those with two edges down, or with one down and one up."""
    ends = e.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (of ``components``) after further links: only what they connect is contracted."""
    a, b = (roots.select(F.col("node").alias(k), F.col("root").alias(f"top_{k}")) for k in "ab")
    edges = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("top_a", "a").alias("a"), F.coalesce("top_b", "b").alias("b"))
    more = components(edges)
    up = more.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return cut(roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(more), "roots")


#: Sets of at most so many elements in all (8 bytes each) are broadcast to the pairs; beyond, both shuffle.
BROADCAST_ELEMENTS = 500_000

#: Longs of a signature of odd bits.
WORDS = 16

#: Members of a bucket that meet in one task.
MEET = 1_000

Near = tuple[DataFrame, Callable[[Column, Column], Column]]


def jaccard(a: str, b: str) -> Column:
    """Similarity of two arrays of distinct values."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def odd_bits(elements: DataFrame, threshold: float) -> Near:
    """A signature of each set of ``id, x`` (one row per element) and a condition that every pair with similarity ``threshold`` meets.

    Each element flips one of 1,024 bits, so two sets differ in at least as many elements as
    their signatures do in bits; their sizes say how many may differ.
    """
    word, bit = F.col("x").bitwiseAND(F.lit(WORDS - 1)), F.shiftrightunsigned("x", 8).bitwiseAND(F.lit(63)).cast("int")
    flip = elements.select("id", word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("flip"))
    sig = flip.groupBy("id").agg(F.count("*").alias("n"), *(F.expr(f"bit_xor(if(word = {k}, flip, 0L))").alias(f"b{k}") for k in range(WORDS)))

    def may(a: Column, b: Column) -> Column:
        unlike = sum((F.bit_count(a[f"b{k}"].bitwiseXOR(b[f"b{k}"])) for k in range(WORDS)), F.lit(0))
        fit = F.least(a["n"], b["n"]) >= threshold * F.greatest(a["n"], b["n"]) - 1e-9
        return fit & (unlike <= (a["n"] + b["n"]) * ((1 - threshold) / (1 + threshold)) + 1e-9)

    return sig.select("id", F.struct("n", *(f"b{k}" for k in range(WORDS))).alias("sig")), may


def class_links(buckets: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: float, near: Near | None = None, expand: Callable[[Column], Column] = lambda s: s) -> DataFrame:
    """Links ``a, b`` (a < b) that join all whose Jaccard similarity reaches ``threshold`` among the ``id``s that share a ``key``; see ``classes``."""
    return classes(buckets, sets, threshold, near, expand)[0]


def class_roots(buckets: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: float, near: Near | None = None, expand: Callable[[Column], Column] = lambda s: s) -> DataFrame:
    """The components of those links, as ``components`` returns them."""
    _, roots, last = classes(buckets, sets, threshold, near, expand)
    return roots if last is None else joined(roots, last)


def classes(buckets: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: float, near: Near | None = None, expand: Callable[[Column], Column] = lambda s: s) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Links, the roots of all but the last ones, and those last ones.

    ``sets`` returns ``id, s`` for the ids it gets, of which ``expand`` makes an array
    of distinct hashes; it is asked once, for all ids that share a key. Rows of
    ``buckets`` may repeat.

    In a bucket the member that meets most others over all its buckets leads, which
    in a group of edited copies is the original, and meets all others: n - 1 pairs.
    Then the same is done for the most met member outside the leader's component.
    What is left open, members of unlike components of one bucket, meets in a join
    on the key and on pairs of blocks of at most about ``MEET`` members. No set goes
    into that join: its condition is that no one component holds both, that signatures are near
    (``odd_bits``, and ``near``: ``id, sig`` and a condition on two ``sig``, if there is one),
    and that the distances to the bucket's leader differ by at most ``1 - threshold`` (a
    metric). The sets of the few pairs that come out are compared. So no link is left out unless
    others connect its ends, and no group's pairs are listed. The work of the last
    join is quadratic only in members that are alike enough to share buckets and yet
    unlike their leaders. Three steps at any size, and each contracts only what its own links connect.
    """
    keys = cut(buckets.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key"), "keys")
    members = cut(buckets.join(small(keys), "key").distinct(), "members")
    found = cut(sets(members.select("id").distinct()), "sets")
    sigs, may = odd_bits(found.select("id", F.explode(expand(F.col("s"))).alias("x")), threshold)
    if near:
        # The caller's signatures rule out most pairs, the odd bits those just below the threshold.
        odd, own = may, near[1]
        sigs = sigs.withColumnRenamed("sig", "odd").join(near[0], "id").select("id", F.struct(F.col("sig").alias("own"), "odd").alias("sig"))
        may = lambda a, b: own(a["own"], b["own"]) & odd(a["odd"], b["odd"])
    sigs = cut(sigs, "odd-bits")
    most = F.struct("score", -F.col("id"))
    score = members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("id").agg(F.sum("n").alias("score"))
    members = swap(members, members.join(score, "id").select("key", "id", "score"), "scored")
    lead = cut(members.groupBy("key").agg(F.max_by("id", most).alias("by")), "leaders")
    length = F.size("s") if isinstance(found.schema["s"].dataType, ArrayType) else F.octet_length("s")
    light = (found.agg(F.sum(length)).first()[0] or 0) <= BROADCAST_ELEMENTS

    def of(table: DataFrame, k: str) -> DataFrame:
        return table.select(F.col("id").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in table.columns if c in ("s", "sig")))

    def compared(pairs: DataFrame) -> DataFrame:
        a, b = (of(found.select("id", "s"), k) for k in "ab")
        if light:
            a, b = F.broadcast(a), F.broadcast(b)
        both = pairs.join(a, "a").join(b, "b").select("a", "b", expand(F.col("s_a")).alias("s_a"), expand(F.col("s_b")).alias("s_b"))
        return both.select("a", "b", jaccard("s_a", "s_b").alias("similarity"))

    roots = links = tried = None
    for turn in range(2):
        if turn:
            main = members.where("id = by").select("key", F.col("comp").alias("main"))
            other = members.join(main, "key").where("comp <> main").groupBy("key").agg(F.max_by(F.struct("id", "comp"), most).alias("other"))
            met = members.join(other, "key").where("comp <> other.comp").select(F.least("id", "other.id").alias("a"), F.greatest("id", "other.id").alias("b"))
            met = met.distinct().join(tried, ["a", "b"], "left_anti")
        else:
            met = members.join(lead, "key").where("id <> by").select(F.least("id", "by").alias("a"), F.greatest("id", "by").alias("b")).distinct()
        met = met.join(of(sigs, "a"), "a").join(of(sigs, "b"), "b").where(may(F.col("sig_a"), F.col("sig_b"))).select("a", "b")
        tried = cut(compared(met), "pairs")
        new = tried.where(F.col("similarity") >= threshold).select("a", "b")
        if not turn:
            links, roots = new, components(new)
            known = tried.select("a", "b", (1 - F.col("similarity")).alias("far"))
            members = members.join(lead, "key").select("key", "id", "score", "by", F.least("id", "by").alias("a"), F.greatest("id", "by").alias("b")).join(known, ["a", "b"], "left")
            members = members.withColumn("far", F.when(F.col("id") == F.col("by"), F.lit(0.0)).otherwise(F.col("far"))).drop("a", "b")
        else:
            links, roots = links.union(new), joined(roots, new)
        tops = roots.select(F.col("node").alias("id"), "root")
        members = cut(members.drop("comp").join(tops, "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root"), "classed")
        mixed = members.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("key")
        members = swap(members, members.join(small(cut(mixed, "mixed")), "key"), "open")
        if is_empty(members):
            release(found, lead, members)
            return links, roots, None
    # Every two blocks of a bucket meet under a key of their own, so no bucket is one task.
    parts = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(MEET)).cast("int").alias("parts"))
    open_ = members.join(parts, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).join(sigs, "id")
    # One table for both sides, so that it is shuffled once: each member under the pairs of its block with every block.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    open_ = open_.withColumn("other", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    side = lambda k: open_.select(*(F.col(c).alias(f"{c}_{k}") for c in open_.columns if c not in ("score", "by", "parts", "other")))
    a, b = side("a"), side("b")
    meet = (F.col("key_a") == F.col("key_b")) & (F.col("i_a") == F.col("i_b")) & (F.col("j_a") == F.col("j_b"))
    # The first member is of the first block, the second of the second one; said in one equation, which cannot be moved before the shuffle.
    wide = F.lit(1 << 31).cast("long")
    meet = meet & (F.col("block_a") * wide + F.col("block_b") == F.col("i_b") * wide + F.col("j_a"))
    meet = meet & ((F.col("i_a") < F.col("j_b")) | (F.col("id_a") < F.col("id_b"))) & (F.col("comp_a") != F.col("comp_b"))
    meet = meet & F.coalesce(F.abs(F.col("far_a") - F.col("far_b")) <= 1 - threshold + 1e-9, F.lit(True)) & may(F.col("sig_a"), F.col("sig_b"))
    met = cut(a.join(b, meet).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct(), "met")
    last = cut(compared(met).where(F.col("similarity") >= threshold).select("a", "b"), "links")
    release(found, lead, members, met)
    return links.union(last), roots, last


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in ``ids`` (one distinct column ``doc_id``, already written)."""
    if len(ids.take(1)) == 0:
        return docs.where("false")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
