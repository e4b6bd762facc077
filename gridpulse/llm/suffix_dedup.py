"""Repeated byte strings by a depth-limited most-significant-digit sort of suffixes.

Suffixes are sorted only through ``length`` bytes, in five digits, and only
groups with more than one member go on to the next digit:

1. the pivot: of all ``PIVOT``-byte strings in the first ``length`` bytes of a
   suffix, the one with the least hash (leftmost on ties), and its distance.
   Equal prefixes have equal pivots, so this digit never parts equal suffixes.
   Neighbouring suffixes share their pivot; such a run is one row.
2. the whole run of neighbouring suffixes: equal runs are equal suffix by suffix.
3. the flank: half of what a string holds besides its pivot lies on the left or
   on the right of it, so equal strings agree on one of the two flanks. Runs
   whose flanks nobody shares end here; of the others only the side that is
   shared goes on.
4. blocks of up to ``BLOCK`` neighbouring suffixes, cut by their distance from the
   pivot: blocks that nobody shares the common bytes of end here, and equal blocks are
   equal suffix by suffix.
5. for one block of each kind that is left, two hashes of the ``length`` bytes at each
   suffix.

Runs whose pivot occurs once end before anything else is compared. The equal groups
left are the repeated windows: strings count as equal if pivot, and the two hashes
of the whole string (or the hash of the whole run), agree, 128 to 192 bits in all.
Groups are counted, never gathered, so a string that a third of all texts hold
costs one counter; the joins that bring counts back can be split. Files of a pass
are removed once the next has read them.

Defined cases: null text is empty; texts shorter than ``length`` keep all;
``doc_id`` is the key; a row repeated in full is a text of its own, so both lose
every byte that a window of ``length`` covers; a null ``doc_id`` keeps all its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, narrow_batches, only, small, swap, texts

LENGTH, PIVOT, BLOCK = 400, 64, 16
U = np.uint64


def window_low(x: np.ndarray, w: int) -> np.ndarray:
    """Leftmost position of the least value in each window of w (block minima from both sides)."""
    n = len(x)
    packed = np.full(-(-n // w) * w, np.iinfo(np.uint64).max)
    bits = max(1, int(n).bit_length())
    packed[:n] = ((x >> U(bits)) << U(bits)) | np.arange(n, dtype=np.uint64)
    blocks = packed.reshape(-1, w)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(left[: n - w + 1], right[w - 1 : n])
    return (low & U((1 << bits) - 1)).astype(np.int64)


def runs(text: np.ndarray, length: int, pivot: int) -> tuple[np.ndarray, ...]:
    """First suffix and number of suffixes of each run, its pivot's place and the running sums.

    Hashes are cut to 40 bits before positions break ties, in every text alike.
    """
    sums = K.prefix(text)
    at = np.arange(len(text) - pivot + 1)
    h = K.spans(sums, at, at + pivot) & U(0xFFFFFFFFFF000000)
    w = length - pivot + 1
    if len(text) < 1 << 24:
        low = window_low(h, w)
    else:  # positions no longer fit below the hash: overlapping parts
        part = (1 << 23) - w
        low = np.concatenate([window_low(h[i : i + part + w - 1], w) + i for i in range(0, len(h) - w + 1, part)])
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    return first, np.diff(np.r_[first, len(low)]), low[first], sums


def find_runs(length: int, pivot: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("digit1", pa.int64()), ("digit2", pa.int64()), ("low", pa.int32()), ("left", pa.int64()), ("right", pa.int64())])
    flank = (length - pivot) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off) = batch.column(0), K.buffers(batch.column(1))
            out: list[list[np.ndarray]] = [[] for _ in range(8)]
            for i in np.flatnonzero(np.diff(off) >= length):
                first, n, low, sums = runs(buf[off[i] : off[i + 1]], length, pivot)
                shape = ((low - first).astype(np.uint64) << U(32)) | n.astype(np.uint64)
                end = low + pivot
                sides = np.where(low - first >= flank, low - flank, -1), np.where(first + n - 1 + length - end >= flank, end, -1)
                # A flank that the run's strings do not hold in full is 0.
                left, right = (np.where(x < 0, U(0), K.spans(sums, np.maximum(x, 0), np.maximum(x, 0) + flank)) for x in sides)
                whole = K.mix(K.spans(sums, first, first + n + length - 1) ^ K.mix(shape))
                for x, y in zip(out, (np.full(len(first), i), first, n, K.spans(sums, low, end), whole, low, left, right)):
                    x.append(y)
            if out[0]:
                row, first, n, d1, d2, low, left, right = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(K.signed(d1)), pa.array(K.signed(d2)), pa.array(low.astype(np.int32)), pa.array(K.signed(left)), pa.array(K.signed(right))], schema=schema)

    return run


def blocks(length: int, size: int):
    """Blocks of the listed runs: place, distance class, hash of the bytes that all suffixes of the class share, two hashes of all bytes."""
    names = ("start", "n", "digit1", "k", "core", "whole", "again")
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int32() if c in ("start", "n", "k") else pa.int64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off), parts = batch.column(0), K.buffers(batch.column(1)), batch.column(2)
            for i in range(batch.num_rows):
                text, mine = buf[off[i] : off[i + 1]], parts[i].values
                start, n, low = (np.asarray(mine.field(c)).astype(np.int64) for c in ("start", "n", "low"))
                near, far = low - start - n + 1, low - start
                count = far // size - near // size + 1
                of = np.repeat(np.arange(len(n)), count)
                k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + (near // size)[of]
                p0, p1 = np.maximum(near[of], k * size), np.minimum(far[of], k * size + size - 1)
                low = low[of]
                one, two = K.prefix(text), K.prefix(text, K.OTHERS)
                shape = K.mix((p0 * length + p1).astype(np.uint64))
                core = K.spans(one, low - k * size, low - k * size - size + 1 + length)
                whole, again = (K.mix(K.spans(x, low - p1, low - p0 + length) ^ shape) for x in (one, two))
                cols = (low - p1, p1 - p0 + 1, np.asarray(mine.field("digit1"))[of], k, K.signed(core), K.signed(whole), K.signed(again))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.full(len(of), i))), *(pa.array(c.astype(np.int32) if schema.field(x).type == pa.int32() else c) for x, c in zip(names, cols))], schema=schema)

    return run


def last_digit(length: int):
    """One row per run: two hashes of each of its suffixes' first ``length`` bytes, from the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("digit1", pa.int64()), ("digits", pa.list_(pa.int64())), ("again", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off) = batch.column(0), K.buffers(batch.column(1))
            parts = batch.column(2)
            for i in range(batch.num_rows):
                text = buf[off[i] : off[i + 1]]
                mine = parts[i].values
                start, n = (np.asarray(mine.field(k)) for k in ("start", "n"))
                o = np.r_[0, np.cumsum(n)]
                at = np.repeat(start - o[:-1], n) + np.arange(o[-1])
                h = [K.lists(K.signed(K.spans(K.prefix(text, v), at, at + length)), o) for v in (K.BYTES, K.OTHERS)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.full(len(n), i))), pa.array(start.astype(np.int32)), mine.field("digit1"), *h], schema=schema)

    return run


def strip(length: int, keep_text: bool):
    """What is left of each text without the bytes that its repeated suffixes cover."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept_text", pa.binary())] if keep_text else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off) = batch.column(0), K.buffers(batch.column(1))
            rows, starts, counts = [], [], []
            for i in range(batch.num_rows):
                text = buf[off[i] : off[i + 1]]
                mine = batch.column(2)[i].values
                removed, spans, kept = 0, 0, text.tobytes()
                if mine is not None and len(mine):
                    first, n = (np.asarray(mine.field(k)).astype(np.int64) for k in ("start", "n"))
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + length - 1, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed, spans = int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum())
                    kept = text[~gone].tobytes()
                rows.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept)[: 4 + keep_text])
            cols = list(zip(*rows)) if rows else [[]] * (4 + keep_text)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t.type) for c, t in zip(cols, list(schema)[1:]))], schema=schema)

    return run


def listed(body: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    """``doc_id, text, parts`` of the documents that have rows, a document's rows as its parts."""
    ids = cut(rows.select("doc_id").distinct(), "ids")
    parts = rows.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("parts"))
    return only(body, ids).join(parts, "doc_id").select("doc_id", "text", "parts")


def repeated(docs: DataFrame, length: int = LENGTH, pivot: int = PIVOT) -> DataFrame:
    """``doc_id, start, n``: runs of suffixes whose first ``length`` bytes start elsewhere too."""
    narrow_batches(docs.sparkSession)
    body = texts(docs)
    found = cut(body.mapInArrow(find_runs(length, pivot), "doc_id long, start int, n int, digit1 long, digit2 long, low int, left long, right long"), "runs")
    pivots = cut(found.groupBy("digit1").agg(F.count("*").alias("c")).where("c > 1").select("digit1"), "pivots")
    found = swap(found, found.join(small(pivots), "digit1", "left_semi"), "live")
    second = found.groupBy("digit1", "digit2").agg(F.count("*").alias("same"), F.min(F.struct("doc_id", "start")).alias("first"))
    first = second.groupBy("digit1").agg(F.sum("same").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    groups = cut(second.join(first, "digit1"), "groups")
    whole = found.join(groups.where("same > 1").select("digit1", "digit2"), ["digit1", "digit2"]).select("doc_id", "start", "n")
    # One run of each kind stands for all equal ones; where kinds differ, their flanks and then their suffixes are told apart.
    mixed = groups.where("kinds > 1")
    open_runs = found.join(mixed.select("digit1", "digit2", "same", "first"), ["digit1", "digit2"]).where(F.col("first") == F.struct("doc_id", "start"))
    open_runs = cut(open_runs.select("doc_id", "start", "n", "digit1", "low", "left", "right"), "open")
    for side in ("left", "right"):
        shared = open_runs.where(f"{side} <> 0").groupBy("digit1", side).agg(F.count("*").alias("c")).where("c > 1").select("digit1", side, F.lit(True).alias(f"on_{side}"))
        open_runs = open_runs.join(shared, ["digit1", side], "left")
    middle = F.col("low") - (length - pivot) // 2
    begin = F.when(F.col("on_left"), F.col("start")).otherwise(F.greatest(F.col("start"), middle))
    stop = F.when(F.col("on_right"), F.col("start") + F.col("n")).otherwise(F.least(F.col("start") + F.col("n"), middle + 1))
    open_runs = open_runs.where("on_left or on_right").select("doc_id", begin.alias("start"), (stop - begin).alias("n"), "digit1", "low").where("n > 0")
    open_runs = cut(open_runs, "shared-flanks")
    kind = "doc_id long, start int, n int, digit1 long, k int, core long, whole long, again long"
    parted = cut(listed(body, open_runs, "start", "n", "digit1", "low").mapInArrow(blocks(length, min(BLOCK, length // 2)), kind), "blocks")
    core = ["digit1", "k", "core"]
    all_of = [*core, "whole", "again"]
    second = parted.groupBy(*all_of).agg(F.count("*").alias("same"), F.min(F.struct("doc_id", "start")).alias("first"))
    first = second.groupBy(*core).agg(F.sum("same").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    groups = cut(second.join(first, core), "block-groups")
    equal = parted.join(groups.where("same > 1").select(*all_of), all_of).select("doc_id", "start", "n")
    left = parted.join(groups.where("kinds > 1").select(*all_of, "first"), all_of).where(F.col("first") == F.struct("doc_id", "start"))
    left = cut(left.select("doc_id", "start", "n", "digit1"), "open-blocks")
    digits = listed(body, left, "start", "n", "digit1").mapInArrow(last_digit(length), "doc_id long, start int, digit1 long, digits array<long>, again array<long>")
    digits = cut(digits, "digits").select("doc_id", "start", F.posexplode("digits").alias("i", "digit4"), "again", "digit1")
    digits = digits.withColumn("digit5", F.get("again", F.col("i"))).drop("again")
    keys = ["digit1", "digit4", "digit5"]
    again = digits.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1").select(*keys)
    single = digits.join(again, keys).select("doc_id", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n"))
    return whole.union(equal).union(single)


def cleaned(docs: DataFrame, length: int = LENGTH, pivot: int = PIVOT, keep_text: bool = True) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if wanted, ``kept_text`` (bytes)."""
    spans = cut(repeated(docs, length, pivot), "spans")
    ids = cut(spans.select("doc_id").distinct(), "span-ids")
    listed = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("parts"))
    # Only texts that lose something travel to their spans.
    body = only(texts(docs), ids).join(listed, "doc_id").select("doc_id", "text", "parts")
    rest = texts(docs).join(small(ids), "doc_id", "left_anti").select("doc_id", "text", F.lit(None).cast("array<struct<start:int,n:int>>").alias("parts"))
    return body.union(rest).mapInArrow(strip(length, keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text binary" * keep_text)
