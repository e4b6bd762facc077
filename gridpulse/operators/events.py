"""Chaining windows into events, clustering events into types, profiles and matches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.signal import average_linkage, bounded_pairs, condensed_distances, full_pairs, ncc_udf, nearest_pairs
from gridpulse.sources.stage import staged


def chain(windows: DataFrame, threshold: float = 0.8, max_lag: int = 5000, by: str = "signal", dense: bool = False) -> DataFrame:
    """``event_idx`` for regular anomalous windows (``regular``): a window joins the event of its predecessor
    by index if that is regular too and similar in column ``by``; similarity is to the immediate predecessor.

    Where indices are ``dense``, windows that are not regular need not be given: a predecessor that is missing is none.
    """
    order = Window.partitionBy("sig_key").orderBy("win_idx")
    was = F.coalesce(F.lag("regular").over(order), F.lit(False))
    if dense:
        was = was & (F.lag("win_idx").over(order) == F.col("win_idx") - 1)
    w = windows.withColumn("__prev", F.lag(by).over(order)).withColumn("__was", was)
    w = w.where("regular").withColumn("sim", F.when(F.col("__was"), ncc_udf(False, max_lag)(F.when(F.col("__was"), F.col("__prev")), by)))
    start = (~F.coalesce(F.col("sim") >= threshold, F.lit(False))).cast("int")
    w = w.withColumn("event_idx", F.sum(start).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return w.drop("__prev", "__was")


def references(chained: DataFrame) -> DataFrame:
    """One row per event: its window with the largest raw maximum, the first on ties."""
    rank = F.row_number().over(Window.partitionBy("sig_key", "event_idx").orderBy(F.array_max("signal").desc(), "win_idx"))
    return chained.withColumn("__r", rank).where("__r = 1").drop("__r")


def metrics(chained: DataFrame, refs: DataFrame, max_lag: int = 5000, by: str = "signal") -> DataFrame:
    """``ncc_vs_ref`` of every window; the reference itself keeps 0."""
    r = refs.select("sig_key", "event_idx", F.col("win_idx").alias("ref_idx"), F.col(by).alias("__ref"))
    w = chained.join(r, ["sig_key", "event_idx"])
    return w.withColumn("ncc_vs_ref", F.when(F.col("win_idx") == F.col("ref_idx"), F.lit(0.0)).otherwise(ncc_udf(False, max_lag)("__ref", by))).drop("__ref")


def rows_of(column: pa.ChunkedArray) -> list:
    """Arrays of a column of lists, null for null."""
    out: list = []
    for c in column.chunks:
        at, flat, there = c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False), c.is_valid().to_numpy(zero_copy_only=False)
        out += [flat[at[k] : at[k + 1]] if there[k] else None for k in range(len(c))]
    return out


#: Rows and columns of pairs that are looked at together.
BLOCK = 2048
#: Any two blocks of windows meet in one task. There are at most so many, so that each window travels as often, however many there are,
PARTS = 16
#: unless the values of a block would pass so many bytes.
BLOCK_BYTES = 64 << 20
#: Windows of a block where every pair is a row of the result.
WHOLE = 1024


def blocks(windows: DataFrame) -> int:
    """Blocks for the rows of ``windows``: few rows are dealt into up to eight, so that more than one task has work."""
    n, values = windows.agg(F.count("*"), F.sum(F.greatest(F.size("window"), F.lit(0)))).first()
    return max(1, min(8, -(-n // 64)), min(PARTS, -(-n // BLOCK)), -(-8 * (values or 0) // BLOCK_BYTES))


def tiles(n: int, m: int, size: int) -> Iterator[tuple[slice, slice]]:
    """Parts of a block of ``n`` by ``m`` pairs, so that what is held for pairs stays the same for blocks of any size."""
    for lo in range(0, n, size):
        for at in range(0, m, size):
            yield slice(lo, lo + size), slice(at, at + size)


def type_pairs(refs: DataFrame, max_lag: int = 5000) -> DataFrame:
    """``sig_key, i, j, ncc`` of all pairs i < j of a signal: average linkage needs each.

    A signal's windows are dealt into blocks, and every two blocks meet in one task, so that
    windows travel once for each block and not once for each pair.
    """
    kinds = {c: refs.schema[c].dataType.simpleString() for c in ("sig_key", "event_idx")}
    few = F.least(F.lit(8), F.ceil(F.count("*") / 64))
    n = refs.groupBy("sig_key").agg(F.greatest(few, F.ceil(F.count("*") / WHOLE)).cast("int").alias("n"))
    rows = refs.select("sig_key", "event_idx", "signal").join(n, "sig_key").withColumn("own", F.pmod(F.xxhash64("event_idx"), F.col("n")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("sig_key", "event_idx", "signal", "own", F.least("own", "o").alias("bi"), F.greatest("own", "o").alias("bj"))

    def run(t: pa.Table) -> pa.Table:
        same, own = t["bi"][0].as_py() == t["bj"][0].as_py(), t["own"].to_numpy()
        a = t.filter(pa.array(own == t["bi"].to_numpy()))
        b = a if same else t.filter(pa.array(own == t["bj"].to_numpy()))
        e, f = a["event_idx"].to_numpy()[:, None], b["event_idx"].to_numpy()[None, :]
        forward, backward = e < f, np.zeros((len(a), len(b)), bool) if same else e > f
        r = bounded_pairs(rows_of(a["signal"]), rows_of(b["signal"]), forward, backward, max_lag)
        i, j = np.nonzero(forward | backward)
        e, f = e[i, 0], f[0, j]
        key = pa.chunked_array([t["sig_key"].slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(i), int)))]) if len(i) else t["sig_key"].slice(0, 0)
        return pa.table({"sig_key": key, "i": np.minimum(e, f), "j": np.maximum(e, f), "ncc": r[i, j]})

    # As many tasks as there is work for: what meets in them is more than what they read.
    rows = rows.repartition(min(1024, max(16, refs.count() // 64)), "sig_key", "bi", "bj")
    return rows.groupBy("sig_key", "bi", "bj").applyInArrow(run, f"sig_key {kinds['sig_key']}, i {kinds['event_idx']}, j {kinds['event_idx']}, ncc double")


def cluster_types(refs: DataFrame, threshold: float = 0.8, max_lag: int = 5000) -> DataFrame:
    """``sig_key, event_idx, type_id`` by average linkage within each signal.

    A task takes its signals one after the other from sorted batches, so that many signals of
    few events cost no call each, and holds one signal at a time.
    """

    def linked(key: str | None, events: list, signals: list) -> tuple:
        types = average_linkage(condensed_distances(np.stack(signals).astype(float), max_lag), 1 - threshold) if len(events) > 1 else np.zeros(1, np.int64)
        return [key] * len(events), events, types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, events, signals = None, [], []

        def written(done: list) -> pa.RecordBatch:
            keys, idx, types = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array([k for ks in keys for k in ks], pa.string()), pa.array(np.concatenate(idx), pa.int64()), pa.array(np.concatenate(types), pa.int64())], ["sig_key", "event_idx", "type_id"])

        for batch in batches:
            done, keys, idx = [], batch.column(0).to_pylist(), batch.column(1).to_numpy()
            rows = rows_of(pa.chunked_array([batch.column(2)]))
            starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
            for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                if events and keys[lo] != key:
                    done.append(linked(key, events, signals))
                    events, signals = [], []
                key = keys[lo]
                events += idx[lo:hi].tolist()
                signals += rows[lo:hi]
            if done:
                yield written(done)
        if events:
            yield written([linked(key, events, signals)])

    rows = refs.select("sig_key", F.col("event_idx").cast("long"), "signal")
    return rows.repartition("sig_key").sortWithinPartitions("sig_key", "event_idx").mapInArrow(run, "sig_key string, event_idx long, type_id long")


def profile(measured: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """One row per event, with its type if there are ``types``; the reference time is that of the first window, duration from first to last start."""
    e = measured.groupBy("sig_key", "event_idx").agg(F.min("start_ts").alias("ref_timestamp"), F.max("start_ts").alias("last_ts"), F.count("*").alias("window_count"), F.max("ref_idx").alias("ref_win_idx"), F.avg("ncc_vs_ref").alias("mean_ncc"), F.array_sort(F.collect_list("start_ts")).alias("window_timestamps"))
    seconds = F.unix_micros(F.col("last_ts").cast("timestamp")) - F.unix_micros(F.col("ref_timestamp").cast("timestamp"))
    e = e if types is None else e.join(types, ["sig_key", "event_idx"])
    return e.withColumn("duration_s", F.greatest(seconds / 1e6, F.lit(0.0)))


def cells(rows: DataFrame, n: int, m: int, side: int) -> DataFrame:
    """``rows`` by the hash of ``id`` in their block of ``n`` (side 0) or ``m`` (side 1), once for every block of the other side."""
    own, other = (n, m) if side == 0 else (m, n)
    mine, met = F.pmod(F.xxhash64("id"), F.lit(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
    return rows.select("*", mine.alias("bi" if side == 0 else "bj"), met.alias("bj" if side == 0 else "bi")).repartition(min(n * m, 1024), "bi", "bj")


def shared_types(summaries: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of types ``sig_key, cid, window`` of different signals whose full-range similarity reaches the threshold."""
    w = summaries.select(F.xxhash64("sig_key", "cid").alias("id"), "sig_key", "cid", "window")
    kinds = {c: summaries.schema[c].dataType.simpleString() for c in ("sig_key", "cid")}
    n, size = blocks(w), BLOCK
    rows = w.withColumn("own", F.pmod("id", F.lit(n)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    rows = rows.select("sig_key", "cid", "window", "own", F.least("own", "o").alias("bi"), F.greatest("own", "o").alias("bj"))
    rows = rows.repartition(min(n * (n + 1) // 2, 1024), "bi", "bj")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        same, own = t["bi"][0].as_py() == t["bj"][0].as_py(), t["own"].to_numpy()
        rank = np.unique(np.asarray(t["sig_key"].to_pandas()), return_inverse=True)[1]
        left = np.flatnonzero(own == t["bi"].to_numpy())
        right = left if same else np.flatnonzero(own == t["bj"].to_numpy())
        windows, names = rows_of(t["window"]), t.select(["sig_key", "cid"]).combine_chunks()
        for p, q in tiles(len(left), len(right), size):
            at, to = left[p], right[q]
            x, y = rank[at][:, None], rank[to][None, :]
            i, j, r = full_pairs([windows[k] for k in at], [windows[k] for k in to], threshold, x < y if same else x != y)
            i, j = at[i], to[j]
            i, j = np.where(rank[i] < rank[j], i, j), np.where(rank[i] < rank[j], j, i)
            a, b = names.take(pa.array(i)), names.take(pa.array(j))
            yield from pa.table({"sig_key_a": a["sig_key"], "cid_a": a["cid"], "sig_key_b": b["sig_key"], "cid_b": b["cid"], "ncc": r}).to_batches()

    return rows.groupBy("bi", "bj").applyInArrow(run, ", ".join(f"{c}_{k} {kinds[c]}" for k in "ab" for c in ("sig_key", "cid")) + ", ncc double")


def sharing(summaries: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``sig_key, cid`` of the types that are in any pair of ``shared_types``, without a list of the pairs.

    A block of windows meets itself first, which settles those that are like many others; the
    ones left open meet all blocks.
    """
    own = summaries.select(F.xxhash64("sig_key", "cid").alias("id"), "sig_key", "cid", "window")
    kinds = ", ".join(f"{c} {summaries.schema[c].dataType.simpleString()}" for c in ("sig_key", "cid"))
    n, size = blocks(own), BLOCK

    def within(t: pa.Table) -> pa.Table:
        rank = np.unique(np.asarray(t["sig_key"].to_pandas()), return_inverse=True)[1]
        windows, found = rows_of(t["window"]), np.zeros(len(t), bool)
        for p, q in tiles(len(t), len(t), size):
            i, j, _ = full_pairs(windows[p], windows[q], threshold, rank[p][:, None] < rank[q][None, :])
            found[p][i] = found[q][j] = True
        return pa.table({"sig_key": t["sig_key"], "cid": t["cid"], "found": found})

    def across(a: pa.Table, b: pa.Table) -> pa.Table:
        found = np.zeros(len(a), bool)
        if len(a) and len(b):
            x, y = rows_of(a["window"]), rows_of(b["window"])
            ka, kb = np.asarray(a["sig_key"].to_pandas()), np.asarray(b["sig_key"].to_pandas())
            for p, q in tiles(len(a), len(b), size):
                open_ = np.arange(len(a))[p][~found[p]]
                found[open_[full_pairs([x[k] for k in open_], y[q], threshold, ka[open_][:, None] != kb[q][None, :])[0]]] = True
        return a.select(["sig_key", "cid"]).filter(pa.array(found))

    rows = own.withColumn("b", F.pmod("id", F.lit(n)).cast("int")).repartition(min(n, 1024), "b")
    first = staged(rows.groupBy("b").applyInArrow(within, f"{kinds}, found boolean"))
    left = own.join(first.where("not found").select("sig_key", "cid"), ["sig_key", "cid"], "left_semi")
    m = blocks(left)
    a, b = (d.select(*(F.col(c).alias(c) for c in ("id", "sig_key", "cid", "window"))) for d in (left, own))
    more = cells(a, m, n, 0).groupBy("bi", "bj").cogroup(cells(b, m, n, 1).groupBy("bi", "bj")).applyInArrow(across, kinds)
    return first.where("found").select("sig_key", "cid").union(more.distinct())


def nearest_type(windows: DataFrame, registry: DataFrame, threshold: float = 0.8, apart: str | None = None) -> DataFrame:
    """Best registry type of each window ``id`` with its similarity; the lowest id on ties, null below the threshold or where there is none.

    With ``apart``, a column of both sides, a window is compared only with types of another value.
    """
    more = [apart] if apart else []
    kinds = windows.schema["id"].dataType.simpleString(), registry.schema["type_id"].dataType.simpleString()
    schema = f"id {kinds[0]}, type_id {kinds[1]}, ncc double"

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"id": a["id"].slice(0, 0), "type_id": b["type_id"].slice(0, 0), "ncc": np.zeros(0)})
        x, y, t = rows_of(a["window"]), rows_of(b["window"]), b["type_id"].to_numpy()
        ka, kb = (np.asarray(c[apart].to_pandas()) if apart else None for c in (a, b))
        found = []
        for p, q in tiles(len(a), len(b), size):
            i, j, r = nearest_pairs(x[p], y[q], ka[p][:, None] != kb[q][None, :] if apart else None)
            found.append(firsts(i + p.start, j + q.start, r, t))
        i, j, r = firsts(*(np.concatenate(c) for c in zip(*found)), t)
        return pa.table({"id": a["id"].take(pa.array(i, pa.int64())), "type_id": b["type_id"].take(pa.array(j, pa.int64())), "ncc": r})

    def firsts(i: np.ndarray, j: np.ndarray, r: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best of each window, the lowest id on ties."""
        order = np.lexsort((t[j], -r, i))
        order = order[np.unique(i[order], return_index=True)[1]] if len(i) else order
        return i[order], j[order], r[order]

    left = windows.select("id", "window", *more)
    right = registry.select(F.col("type_id").alias("id"), "window", *more, F.col("type_id").alias("type_id"))
    n, m, size = blocks(left), blocks(right), BLOCK
    # Columns of their own, where both sides are one table.
    a, b = (d.select(*(F.col(c).alias(c) for c in d.columns)) for d in (left, right))
    scored = cells(a, n, m, 0).groupBy("bi", "bj").cogroup(cells(b, n, m, 1).groupBy("bi", "bj")).applyInArrow(run, schema)
    best = scored.groupBy("id").agg(F.max(F.struct("ncc", (-F.col("type_id")).alias("t"))).alias("b"))
    out = windows.select("id").join(best, "id", "left")
    return out.select("id", F.when(F.col("b.ncc") >= threshold, -F.col("b.t")).cast(kinds[1]).alias("type_id"), F.col("b.ncc").alias("ncc"))
