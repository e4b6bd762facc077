"""Near-duplicate documents by BagMinHash over the multiset of five-word shingles.

Every shingle with its count is a weight on the line [0, count). The line is cut
into dyadic levels [0,1), [1,2), [2,4), ... and each level has a Poisson process
whose rate is its length; a point has a time, a position on the line and one of
``m`` signature components. A component's value is the earliest time among its
points below the weight, so two documents agree on it with probability equal to
their weighted Jaccard similarity. Points are generated in order of time and a
process stops once it is later than everything the signature can still use.

The dyadic levels of a shingle are independent processes, not split from a parent,
which gives the same law for the earliest times.

Copies (equal multisets) are one class before any comparison. Bands of the
signatures form buckets, ``class_roots`` pairs within them, pairs of which too many
components differ (four bits of each are kept) go no further, and the exact weighted
Jaccard over the whole texts decides. A pair at similarity 0.8 shares a bucket with
probability 0.998 and passes the count of components with 0.9998; both rise with
similarity.

Defined cases: null text is empty; a document without a word is alone; one with
fewer than five words has a single shingle of all; ``doc_id`` is the key, rows
repeated in full are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import class_roots, cut, narrow_batches, only, texts

BANDS, ROWS = 21, 6
SIMILARITY = 0.8
#: Longs of sixteen four-bit components each, and the standard deviations that the count of unlike ones may lie above its mean.
PACKED, SPREAD = 16, 3.6
U = np.uint64


def bags(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of each row."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return row[new], h[new], np.diff(np.r_[new, len(h)])


def signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) earliest times; infinity throughout for a row without shingles."""
    sig = np.full(n * m, np.inf)
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    i = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(i)) - np.repeat(np.cumsum(levels) - levels, levels)
    low, rate = np.where(level == 0, 0.0, 2.0 ** (level - 1)), np.where(level <= 1, 1.0, 2.0 ** (level - 1.0))
    doc, w, t = row[i], weight[i].astype(float), np.zeros(len(i))
    state = K.mix(h[i] + (level.astype(np.uint64) + U(1)) * K.BASE)
    while len(doc):
        state = state + U(0xD1B54A32D192ED03)
        x = K.mix(state)
        t = t - np.log(((x >> U(11)).astype(float) + 0.5) * 2.0**-53) / rate
        y = K.mix(x)
        at = low + rate * ((y >> U(32)).astype(float) * 2.0**-32)
        k = ((y & U(0xFFFFFFFF)) % U(m)).astype(np.int64)
        hit = at < w
        np.minimum.at(sig, doc[hit] * m + k[hit], t[hit])
        go = t < sig.reshape(n, m).max(axis=1)[doc]
        doc, w, t, state, low, rate = doc[go], w[go], t[go], state[go], low[go], rate[go]
    return sig.reshape(n, m)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])


def sign(bands: int, rows: int):
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off) = batch.column(0), K.buffers(batch.column(1))
            for lo, hi in K.steps(off):
                n, o = hi - lo, off[lo : hi + 1] - off[lo]
                _, _, row, h = K.words(buf[off[lo] : off[hi]], o)
                row, _, h = K.shingles(row, h)
                count = np.bincount(row, minlength=n)
                row, h, weight = bags(row, h, n)
                wide = weight.astype(np.uint64)
                d = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                for x, seed in zip(d, (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F))):
                    np.add.at(x, row, K.mix(h ^ seed) * wide)
                bits = signatures(row, h, weight, n, m).view(np.uint64).reshape(n, bands, rows)
                key = np.broadcast_to((np.arange(bands, dtype=np.uint64) + U(1)) * K.BASE, (n, bands))
                for r in range(rows):
                    key = K.mix(key ^ bits[:, :, r])
                values = pa.array(K.signed(np.ascontiguousarray(key)).ravel())
                packed = np.zeros((n, -(-m // PACKED)), np.uint64)
                nibbles = K.mix(bits.reshape(n, m)) >> U(60)
                for c in range(m):
                    packed[:, c // PACKED] |= nibbles[:, c] << U(4 * (c % PACKED))
                longs = pa.array(K.signed(packed.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n), pa.array(count), pa.array(K.signed(d[0])), pa.array(K.signed(d[1])), K.lists(values, np.arange(n + 1) * bands), K.lists(longs, np.arange(n + 1) * packed.shape[1])], schema=SIGNED)

    return run


def alike(m: int, similarity: float):
    """A condition on two packed signatures of m components: no more unlike ones than a similar pair has."""
    differ = (1 - similarity) * 15 / 16
    most = math.floor(m * differ + SPREAD * math.sqrt(m * differ * (1 - differ)))

    def unlike(x: Column) -> Column:
        half = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(F.lit(0x1111111111111111))).cast("int")

    def run(a: Column, b: Column) -> Column:
        return sum((unlike(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(-(-m // PACKED))), F.lit(0)) <= most

    return run


def multisets():
    schema = pa.schema([("id", pa.int64()), ("s", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (buf, off) = batch.column(0), K.buffers(batch.column(1))
            for lo, hi in K.steps(off):
                n = hi - lo
                _, _, row, h = K.words(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                row, _, h = K.shingles(row, h)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])][: len(h)]
                at = np.arange(len(h))
                nth = at - np.maximum.accumulate(np.where(new, at, 0))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n), K.lists(K.signed(K.mix(h + nth.astype(np.uint64) * K.BASE)), K.ragged(row, n))], schema=schema)

    return run


def expanded(docs: DataFrame):
    """The multisets of documents as sets: the k-th of equal shingles is an element of its own, so that their Jaccard similarity is the weighted one."""

    def run(ids: DataFrame) -> DataFrame:
        ids = cut(ids.select(F.col("id").alias("doc_id")), "ids")
        return only(texts(docs), ids).mapInArrow(multisets(), "id long, s array<long>").dropDuplicates(["id"])

    return run


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, n_shingles, kept``.

    ``class_id`` is the smallest ``doc_id`` of the class; that document is kept.
    """
    narrow_batches(docs.sparkSession)
    signed = cut(texts(docs).mapInArrow(sign(bands, rows), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sig array<long>"), "signed")
    first = cut(signed.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "first")
    own = signed.withColumnRenamed("doc_id", "id").join(first.select("id", "d1", "d2"), ["id", "d1", "d2"], "left_semi").dropDuplicates(["id"])
    own = cut(own.select("id", "bands", "sig"), "own")
    roots = class_roots(own.select("id", F.explode("bands").alias("key")), expanded(docs), similarity, (own.select("id", "sig"), alike(bands * rows, similarity)))
    classes = first.join(roots.withColumnRenamed("node", "id"), "id", "left").select("d1", "d2", "copies", F.coalesce("root", "id").alias("class_id"))
    classes = cut(classes, "classes")
    sizes = classes.groupBy("class_id").agg(F.sum("copies").alias("class_size"))
    classes = classes.drop("copies").join(sizes, "class_id")
    found = signed.drop("bands", "sig").join(classes, (signed.d1 == classes.d1) & (signed.d2 == classes.d2) & (signed.n_shingles > 0), "left")
    own = F.coalesce("class_id", "doc_id")
    return found.select("doc_id", own.alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), "n_shingles", own.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class; its columns are unchanged."""
    gone = near_duplicates(docs, similarity).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs.doc_id == gone["__gone"], "left_anti")
