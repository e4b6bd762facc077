"""Joins on time: pairs within some seconds, the last row before a time, captures around peaks.

Time is cut into buckets, so that each join is an equi-join on the bucket with the exact
test as a condition; a bucket that holds too many rows is split into explicit blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.operators.windows import micros

#: At most so many hot buckets are broadcast to split the rows in them; beyond, both sides shuffle.
BROADCAST_BUCKETS = 100_000
#: At most so many partitions of the lake are named in a filter; beyond, a semi-join prunes them as the scan runs.
NAMED_PARTITIONS = 10_000


def bucket_of(ts: Column, width: int) -> Column:
    return F.floor(ts / F.lit(width)).cast("long")


def interval_join(left: DataFrame, right: DataFrame, before_s: float, after_s: float, on: tuple[str, ...] = (), block: int = 4_000) -> DataFrame:
    """All pairs of rows equal in ``on`` with the right ``ts`` from ``before_s`` before to ``after_s`` after the left one, both included.

    Columns come back with ``_a`` (left) and ``_b`` (right), those of ``on`` as they are. A left
    row lies in one bucket, a right row in each that it may meet, so a pair is found once.
    In a bucket of more than ``block`` rows of a side, each side is dealt into blocks and
    every two blocks meet under a key of their own. Null times and keys meet nothing.
    """
    before, after = round(before_s * 1e6), round(after_s * 1e6)
    width = max(before + after, 1)
    a = left.select(*on, *(F.col(c).alias(f"{c}_a") for c in left.columns if c not in on)).where("ts_a is not null")
    b = right.select(*on, *(F.col(c).alias(f"{c}_b") for c in right.columns if c not in on)).where("ts_b is not null")
    a = a.withColumn("__at", micros("ts_a")).withColumn("__bucket", bucket_of(F.col("__at"), width))
    b = b.withColumn("__to", micros("ts_b"))
    b = b.withColumn("__bucket", F.explode(F.sequence(bucket_of(F.col("__to") - after, width), bucket_of(F.col("__to") + before, width))))
    cell = [*on, "__bucket"]
    sizes = [d.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias(k)) for d, k in ((a, "__na"), (b, "__nb"))]
    hot = sizes[0].join(sizes[1], cell).where("__na > 1 or __nb > 1")
    n = hot.count()
    if n:
        hot = F.broadcast(hot) if n <= BROADCAST_BUCKETS else hot
        one = F.lit(1)
        split = lambda d, own, other: (
            d.join(hot, cell, "left").withColumn("__own", F.pmod(F.xxhash64(*d.columns), F.coalesce(F.col(own), one)).cast("int"))
            .withColumn("__met", F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), one) - 1))).drop("__na", "__nb")
        )
        a = split(a, "__na", "__nb").withColumnRenamed("__own", "__i").withColumnRenamed("__met", "__j")
        b = split(b, "__nb", "__na").withColumnRenamed("__own", "__j").withColumnRenamed("__met", "__i")
        cell = [*cell, "__i", "__j"]
    near = (F.col("__to") >= F.col("__at") - before) & (F.col("__to") <= F.col("__at") + after)
    return a.join(b, cell).where(near).drop("__at", "__to", "__bucket", "__i", "__j")


#: Signals are dealt into up to so many blocks, and every two blocks meet in one task.
SIGNAL_BLOCKS = 16
#: About so many pairs are looked at at once.
PAIRS = 2_000_000


def near_pairs(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int):
    """Rows of both sides, ``at[k]`` with each of ``lo[k]`` to ``hi[k]``, about ``step`` pairs at a time."""
    n = hi - lo
    ends = np.cumsum(n)
    for first in range(0, int(ends[-1]) if len(ends) else 0, step):
        last = min(first + step, int(ends[-1]))
        k0, k1 = np.searchsorted(ends, [first, last - 1], "right")
        k = np.arange(k0, k1 + 1)
        left, right = np.maximum(first - (ends[k] - n[k]), 0), np.minimum(last - (ends[k] - n[k]), n[k])
        take = right - left
        yield np.repeat(at[k], take), np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + np.repeat(lo[k] + left, take)


def once(x: np.ndarray) -> np.ndarray:
    """Distinct values by sorting, which takes less than the hash table of ``np.unique`` for codes like these."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def count_near(us: np.ndarray, sig: np.ndarray, cid: np.ndarray, ev: np.ndarray, side: np.ndarray | None, width: int, step: int = PAIRS) -> dict[tuple[int, int], list[int]]:
    """Per pair of types: pairs of events, pairs of signals, the sum and the least of their distances.

    Rows of ``side`` False meet those of ``side`` True; without it all meet those of later signals. Signals
    of the first side come one by one or several together, so that pairs of signals are counted once.
    """
    order = np.argsort(us, kind="stable")
    us, sig, cid, ev = us[order], sig[order], cid[order], ev[order]
    place = np.empty(len(us), np.int64)
    place[np.lexsort((sig, ev, cid))] = np.arange(len(us))
    rows = np.arange(len(us)) if side is None else np.flatnonzero(~side[order])
    mates = np.arange(len(us)) if side is None else np.flatnonzero(side[order])
    lo = np.searchsorted(us[mates], us[rows] - width, "left")
    hi = np.searchsorted(us[mates], us[rows] + width, "right")
    by = np.lexsort((rows, sig[rows]))
    rows, lo, hi = rows[by], lo[by], np.maximum(hi[by], lo[by])
    # Runs of whole signals of about ``step`` pairs; one signal may have more.
    starts = np.flatnonzero(np.r_[True, sig[rows][1:] != sig[rows][:-1]]) if len(rows) else np.zeros(0, int)
    total = np.r_[0, np.cumsum(hi - lo)]
    out: dict[tuple[int, int], list[int]] = {}
    s = int(sig.max(initial=0)) + 1
    c = int(cid.max(initial=0)) + 1
    while len(starts):
        n = max(1, int(np.searchsorted(total[starts], total[starts[0]] + step, "left")))
        a, z = starts[0], starts[n] if n < len(starts) else len(rows)
        starts, seen = starts[n:], []
        for p, q in near_pairs(rows[a:z], lo[a:z], hi[a:z], step):
            q = mates[q]
            apart = sig[p] < sig[q] if side is None else sig[p] != sig[q]
            p, q = p[apart], q[apart]
            back = place[q] < place[p]
            p, q = np.where(back, q, p), np.where(back, p, q)
            kind, gap = cid[p] * c + cid[q], np.abs(us[q] - us[p])
            # Few types are counted by their number, many by the place among those that are met.
            kinds, own = (np.arange(c * c), kind) if c * c <= len(kind) else np.unique(kind, return_inverse=True)
            least = np.full(len(kinds), np.iinfo(np.int64).max)
            np.minimum.at(least, own, gap)
            m, t = np.bincount(own, minlength=len(kinds)), np.bincount(own, gap, minlength=len(kinds)).astype(np.int64)
            for k in np.flatnonzero(m):
                o = out.setdefault((int(kinds[k]) // c, int(kinds[k]) % c), [0, 0, 0, int(least[k])])
                o[0], o[2], o[3] = o[0] + int(m[k]), o[2] + int(t[k]), min(o[3], int(least[k]))
            seen.append(once((kind * s + sig[p]) * s + sig[q]))
        if seen:
            for k, m in zip(*(x.tolist() for x in np.unique(once(np.concatenate(seen) if len(seen) > 1 else seen[0]) // (s * s), return_counts=True))):
                out[k // c, k % c][1] += m
    return out


def cooccurrence(events: DataFrame, seconds: float = 30.0) -> DataFrame:
    """Types of events that come within ``seconds`` of each other in different signals.

    ``events`` has ``sig_key, cid, event_id, ts``, of which ``cid, event_id, sig_key`` name an
    event. Per pair of types ``cid_a <= cid_b``: ``n_pairs`` of events, ``n_signals`` pairs of
    signals, the mean and the least distance in seconds. Each pair of events counts once.

    Signals are dealt into blocks and every two blocks meet in one task, so that an event is
    sent a bounded number of times, pairs are never shuffled, and all of a pair of signals is in one task.
    """
    e = events.select("sig_key", "cid", "event_id", micros("ts").alias("us")).where("sig_key is not null and cid is not null and us is not null")
    kind = events.schema["cid"].dataType.simpleString()
    n = int(max(2, min(SIGNAL_BLOCKS, -(-e.count() // 100_000))))
    rows = e.withColumn("own", F.pmod(F.xxhash64("sig_key"), F.lit(n)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    rows = rows.select("sig_key", "cid", "event_id", "us", "own", F.least("own", "o").alias("bi"), F.greatest("own", "o").alias("bj"))
    width = round(seconds * 1e6)

    def run(t: pa.Table) -> pa.Table:
        same = t["bi"][0].as_py() == t["bj"][0].as_py()
        code = lambda c: pc.rank(t[c].combine_chunks(), null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64) - 1
        cid, side = code("cid"), None if same else t["own"].to_numpy() == t["bj"].to_numpy()
        found = count_near(t["us"].to_numpy(), code("sig_key"), cid, code("event_id"), side, width)
        place = np.zeros(int(cid.max()) + 1, np.int64)
        place[cid] = np.arange(len(cid))
        a, b = (t["cid"].take(pa.array([place[k[i]] for k in found], pa.int64())) for i in (0, 1))
        return pa.table({"cid_a": a, "cid_b": b, **{c: pa.array([v[i] for v in found.values()], pa.int64()) for i, c in enumerate(("n_pairs", "n_signals", "s", "least"))}})

    rows = rows.repartition(n * (n + 1) // 2, "bi", "bj")
    found = rows.groupBy("bi", "bj").applyInArrow(run, f"cid_a {kind}, cid_b {kind}, n_pairs long, n_signals long, s long, least long")
    out = found.groupBy("cid_a", "cid_b").agg(*(F.sum(c).alias(c) for c in ("n_pairs", "n_signals", "s")), F.min("least").alias("least"))
    return out.select("cid_a", "cid_b", "n_pairs", "n_signals", F.round(F.col("s") / F.col("n_pairs") / 1e6, 4).alias("mean_gap_s"), (F.col("least") / 1e6).alias("least_gap_s"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], tolerance_s: float) -> DataFrame:
    """``left`` with ``found``: the columns of the last row of ``right`` at or before its ``ts``, less than ``tolerance_s`` old; null if there is none.

    Both have ``keys, ts``; of equal times the greatest row counts. Both sides are put in
    one order per key and bucket of ``tolerance_s``, and the last non-null is carried
    forward; a right row stands in its bucket and the next, so no key is one task.
    """
    width = round(tolerance_s * 1e6)
    other = [c for c in right.columns if c not in keys]
    row = F.struct("ts", *(c for c in other if c != "ts"))
    r = right.where("ts is not null").select(*keys, micros("ts").alias("__at"), row.alias("found"))
    r = r.withColumn("__bucket", F.explode(F.array(bucket_of(F.col("__at"), width), bucket_of(F.col("__at"), width) + 1)))
    own = left.select(*keys, micros("ts").alias("__at"), F.struct(*left.columns).alias("__row")).withColumn("__bucket", bucket_of(F.col("__at"), width))
    both = own.unionByName(r, allowMissingColumns=True).withColumn("__late", F.col("__row").isNotNull())
    order = Window.partitionBy(*keys, "__bucket").orderBy("__at", "__late", "found")
    both = both.withColumn("found", F.last("found", ignorenulls=True).over(order)).where("__late")
    fresh = F.col("__at") - micros("found.ts") < width
    return both.select("__row.*", F.when(fresh, F.col("found")).alias("found"))


#: Names of captures and of peak images, and the minutes a capture covers.
CAPTURE_NAME = r"(\d{4}-\d{2}-\d{2})_(\d{2})-(\d{2})\.txt$"
PEAK_NAME = r"timestamp_(\d{4}-\d{2}-\d{2})_(\d{2})-(\d{2})-(\d{2})\.png$"
COVER_MIN = 30


def named_time(path: str, pattern: str) -> Column:
    """The time in a name of captures or peak images, null for other names."""
    p = F.element_at(F.split(F.col(path), "/"), -1)
    part = lambda k: F.regexp_extract(p, pattern, k)
    seconds = part(4) if pattern == PEAK_NAME else F.lit("00")
    return F.when(part(1) != "", F.concat(part(1), F.lit(" "), part(2), F.lit(":"), part(3), F.lit(":"), seconds).try_cast("timestamp_ntz"))


def covering(peaks: DataFrame, captures: DataFrame, keys: list[str], minutes: float = COVER_MIN) -> DataFrame:
    """``peaks`` (``keys, ts``) with ``start_ts`` of the capture (``keys, ts``) that covers each, null if none does."""
    found = as_of(peaks, captures.select(*keys, "ts"), keys, minutes * 60)
    return found.withColumn("start_ts", F.col("found.ts")).drop("found")


def around_peaks(peaks: DataFrame, samples: DataFrame, keys: list[str], seconds: float = 1.0, minutes: float = COVER_MIN) -> DataFrame:
    """Per peak of ``covering`` with a capture: ``n`` samples within ``seconds`` of it in the capture's time, as ``signal`` with ``offset_s``, in order.

    ``samples`` has ``keys, ts, tie, signal``. A peak is named by ``keys``, its ``ts`` and ``start_ts``.
    """
    p = peaks.where("start_ts is not null").select(*keys, "ts", "start_ts").distinct()
    near = interval_join(p, samples.select(*keys, "ts", "tie", "signal"), seconds, seconds, tuple(keys))
    inside = (F.col("ts_b") >= F.col("start_ts_a")) & (micros("ts_b") < micros("start_ts_a") + round(minutes * 60e6))
    at = (micros("ts_b") - micros("ts_a")) / 1e6
    rows = F.array_sort(F.collect_list(F.struct(at.alias("offset_s"), F.col("tie_b"), F.col("signal_b").cast("double").alias("signal"))))
    out = near.where(inside).groupBy(*keys, F.col("ts_a").alias("ts"), F.col("start_ts_a").alias("start_ts")).agg(rows.alias("r"))
    return out.select(*keys, "ts", "start_ts", F.size("r").alias("n"), F.transform("r", lambda x: x["signal"]).alias("signal"), F.transform("r", lambda x: x["offset_s"]).alias("offset_s"))


def peak_partitions(peaks: DataFrame, lake: DataFrame, seconds: float = 1.0) -> DataFrame:
    """Rows of ``lake`` (partitioned by ``boitier, voie, date``) in the partitions that hold something near a peak (``boitier, voie, ts``).

    Few partitions are named in the filter, so that the scan opens no others.
    """
    parts = ["boitier", "voie", "date"]
    near = F.array(*(F.to_date(F.timestamp_micros(micros("ts") + round(s * 1e6))) for s in (-seconds, seconds)))
    wanted = peaks.where("ts is not null").select("boitier", "voie", F.explode(near).alias("date")).distinct()
    some = wanted.limit(NAMED_PARTITIONS + 1).collect()
    if len(some) > NAMED_PARTITIONS:
        return lake.join(wanted, parts, "left_semi")
    if not some:
        return lake.where("false")
    for c in parts:
        lake = lake.where(F.col(c).isin(*sorted({r[c] for r in some})))
    return lake.join(F.broadcast(wanted), parts, "left_semi")
