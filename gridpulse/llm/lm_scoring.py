"""Scoring texts by the marginal likelihood of a subword lattice.

A text's words, each after a word mark, are spelled by the pieces of an existing
vocabulary. Piece probabilities start from the vocabulary's own scores and are
re-estimated on the training words by expectation maximisation (forward-backward
over all segmentations); the vocabulary stays as it is. A word's probability is
the sum over all its segmentations, by a forward recursion in log space; a
text's is the product over its words and one end.

Words are counted once for the whole corpus; lattices run once per distinct word,
distributed. The ``frequent`` most common words (a fixed number) are sent to
every executor; every other occurrence is joined with the full table of words.

Defined cases: null text is empty (its only token is the end); without training
rows all counts are 0 and pieces keep their first probabilities; a row repeated
in full trains as often as it occurs and has as many rows in the result; a null
``doc_id`` is never held out; an empty table gives an empty result. A very long word takes
time in proportion to its bytes, some seconds a megabyte and pass.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, narrow_batches, texts

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT, ROUNDS, HELD = 100_000, 3, 10
#: Distinct words that one task holds before it hands them on.
HELD_WORDS = 300_000
#: Depths of a lattice with fewer edges are not worth a step over arrays.
FEW_EDGES = 64
U = np.uint64
MARK = "▁".encode()


def vocabulary(path: str = PIECES) -> tuple[list[bytes], np.ndarray]:
    """Byte strings of the pieces and first log probabilities from their scores.

    Scores that rank merges (0, -1, -2, ...) become a rank-frequency law; pieces
    marked unused (scores below -1e6) and control pieces are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=str(Path(path)))
    names, scores, fallback = [], [], []
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            fallback.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.get_score(i) < -1e6):
            names.append(sp.id_to_piece(i).encode())
            scores.append(sp.get_score(i))
    rank = np.argsort(np.argsort(-np.asarray(scores), kind="stable"), kind="stable")
    first = np.r_[1 / (rank + 2.7), np.full(256, 1e-6)]
    held = set(names)
    keep = [i for i, b in enumerate(fallback) if b not in held]
    first = np.r_[first[: len(names)], first[len(names) :][: len(keep)]]
    return names + [fallback[i] for i in keep], np.log(first / first.sum())


class Lattice:
    """All segmentations of many words at once."""

    def __init__(self, names: list[bytes]) -> None:
        h = K.hashes(pa.array(names, pa.binary()))
        order = np.argsort(h)
        self.keys, self.ids, self.size = h[order], order, len(names)
        self.lengths = {len(x) for x in names}
        self.longest = max(self.lengths, default=0)
        # Bits of all prefixes of pieces: a place is given up at the first length that no piece begins with.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[K.hashes(pa.array({x[:n] for x in names for n in range(1, len(x) + 1)}, pa.binary())) & U((1 << 22) - 1)] = True

    def edges(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, end and piece of all edges over words that lie one after the other in ``buf``."""
        sums = K.prefix(buf)
        last = np.repeat(off[1:], np.diff(off))
        s = np.arange(len(buf))
        found = [(s[:0], s[:0], self.ids[:0])]
        for n in range(1, self.longest + 1):
            s = s[s + n <= last[s]]
            h = K.spans(sums, s, s + n)
            ok = self.maybe[h & U((1 << 22) - 1)]
            s, h = s[ok], h[ok]
            if n in self.lengths and len(s):
                i = np.minimum(np.searchsorted(self.keys, h), self.size - 1)
                ok = self.keys[i] == h
                found.append((s[ok], np.full(int(ok.sum()), n), self.ids[i[ok]]))
        start, n, piece = (np.concatenate(x) for x in zip(*found))
        return start, start + n, piece

    def forward(self, buf: np.ndarray, off: np.ndarray, logp: np.ndarray, back: bool = False):
        """Log marginal of each word; with ``back`` also edges, their posterior probabilities and pieces."""
        start, end, piece = self.edges(buf, off)
        word = np.searchsorted(off, start, "right") - 1
        # Nodes: one more than bytes per word.
        node = start + word
        to = end + word
        nodes = len(buf) + len(off) - 1
        heads, tails = off[:-1] + np.arange(len(off) - 1), off[1:] + np.arange(len(off) - 1)
        alpha = self.relax(node, to, end - off[word], logp[piece], nodes, heads)
        total = alpha[tails]
        if not back:
            return total
        beta = self.relax(to, node, off[word + 1] - start, logp[piece], nodes, tails)
        with np.errstate(over="ignore", invalid="ignore"):
            post = np.exp(alpha[node] + logp[piece] + beta[to] - total[word])
        return total, word, np.nan_to_num(post), piece

    @staticmethod
    def relax(a: np.ndarray, b: np.ndarray, depth: np.ndarray, w: np.ndarray, nodes: int, roots: np.ndarray) -> np.ndarray:
        """Log sums of all paths from roots, edge by edge in order of depth of the edge's far end."""
        out = np.full(nodes, -np.inf)
        out[roots] = 0.0
        order = np.argsort(depth * nodes + b)
        a, b, depth, w = a[order], b[order], depth[order], w[order]
        cuts = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1]]) if len(depth) else np.zeros(0, np.int64)
        ends = np.r_[cuts[1:], len(depth)]
        # From here on all depths have few edges, as where one word is much longer than the others: those go one by one.
        many = np.flatnonzero(ends - cuts >= FEW_EDGES)
        tail = int(many[-1]) + 1 if len(many) else 0
        for lo, hi in zip(cuts[:tail], ends[:tail]):
            x, t = out[a[lo:hi]] + w[lo:hi], b[lo:hi]
            first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            top = np.maximum.reduceat(x, first)
            safe = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                out[t[first]] = safe + np.log(np.add.reduceat(np.exp(x - np.repeat(safe, np.diff(np.r_[first, len(x)]))), first))
        return out if tail == len(cuts) else one_by_one(out, a[cuts[tail] :], b[cuts[tail] :], w[cuts[tail] :])


def one_by_one(out: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``relax`` of edges that lie by far end: some microseconds an end, whatever the length of the word."""
    held, low, exp, log = out.tolist(), -math.inf, math.exp, math.log
    at, top, total = -1, low, 0.0
    for x, y, v in zip(a.tolist(), b.tolist(), w.tolist()):
        if y != at:
            if at >= 0 and top > low:
                held[at] = top + log(total)
            at, top, total = y, low, 0.0
        s = held[x] + v
        if s > top:
            total = total * exp(top - s) + 1.0
            top = s
        elif s > low:
            total += exp(s - top)
    if at >= 0 and top > low:
        held[at] = top + log(total)
    return np.array(held)


def marked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the words, each after a word mark."""
    buf, off = K.buffers(column)
    size = np.diff(off)
    new = np.r_[0, np.cumsum(size + len(MARK))]
    out = np.empty(int(new[-1]), np.uint8)
    if len(size):
        body = np.ones(len(out), bool)
        for j, b in enumerate(MARK):
            out[new[:-1] + j] = b
            body[new[:-1] + j] = False
        out[body] = buf[off[0] : off[-1]]
    return out, new


_lattices: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    if path not in _lattices:
        _lattices[path] = Lattice(vocabulary(path)[0])
    return _lattices[path]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training rows with counts; words of held-out rows with 0."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)
        counts.clear()
        return out

    for batch in batches:
        for text, held in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            words = text.lower().split()
            if held:
                for w in set(words):
                    counts[w] += 0
            else:
                counts.update(words)
            if len(counts) > HELD_WORDS:
                yield flush()
    yield flush()


def expected(path: str, logp: np.ndarray):
    schema = pa.schema([("piece", pa.int32()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(logp))
        for batch in batches:
            c = np.asarray(batch.column(1)).astype(float)
            buf, off = marked(batch.column(0))
            for lo, hi in K.steps(off, K.CHUNK // 8):
                _, word, post, piece = lattice(path).forward(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], logp, back=True)
                total += np.bincount(piece, post * c[lo:hi][word], len(logp))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    return run


def marginals(path: str, logp: np.ndarray):
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("lp", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = marked(batch.column(0))
            got = [lattice(path).forward(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], logp) for lo, hi in K.steps(off, K.CHUNK // 8)]
            lp = np.concatenate(got) / math.log(10) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lp)], schema=schema)

    return run


def score_frequent(table) -> object:
    """Sums over frequent words, known by two hashes; the other words as a list."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rest", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, others, known, base, lp = table.value
        for batch in batches:
            buf, off = K.buffers(batch.column(3))
            for lo, hi in K.steps(off):
                n, b, o = hi - lo, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                start, end, row, h = K.words(b, o, lower=True)
                i = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                again = K.spans(K.prefix(K.LOWER[b], K.OTHERS), start, end)
                ok = (keys[i] == h) & (others[i] == again) if len(keys) else np.zeros(len(h), bool)
                sums = [np.bincount(row[ok], x[i[ok]], n) for x in (known, base, lp)]
                s, e, r = start[~ok], end[~ok], row[~ok]
                size = e - s
                to = np.r_[0, np.cumsum(size)]
                data = K.LOWER[b[np.repeat(s - to[:-1], size) + np.arange(to[-1])]] if len(s) else np.zeros(0, np.uint8)
                rest = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, n) for k in range(3)), pa.array(np.bincount(row, minlength=n)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), K.lists(rest, K.ragged(r, n))], schema=schema)

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD == 0, F.lit(False))


def score(docs: DataFrame, path: str = PIECES, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each document (log10)."""
    spark = docs.sparkSession
    narrow_batches(spark)
    body = texts(docs).withColumn("held_out", held_out(F.col("doc_id")))
    counted = body.select("text", "held_out").mapInArrow(count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counted = cut(counted, "words")
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    ends = body.where("not held_out").count()
    n, v = n + ends, v + bool(ends)
    logp = vocabulary(path)[1]
    end_lp = math.log(0.5 if not ends else ends / n)
    narrow_batches(spark, 20_000)
    train = counted.where("c > 0")
    for _ in range(rounds if v > 1 else 0):
        got = np.full(len(logp), 0.01)
        # At most one row per piece of the vocabulary.
        for r in train.mapInArrow(expected(path, logp), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            got[r["piece"]] += r["n"]
        logp = np.log(got / (got.sum() + ends))
        end_lp = math.log(max(ends, 0.5) / (got.sum() + ends))
    end_lp /= math.log(10)
    scored = cut(counted.mapInArrow(marginals(path, logp), "word binary, c long, lp double"), "scored")
    unit = n + 0.1 * (v + 1)
    term = F.log10((F.col("c") + 0.1) / F.lit(unit))
    top = scored.orderBy(F.desc("c"), "word").limit(frequent).select("word", (F.col("c") > 0).cast("double").alias("known"), term.alias("base"), "lp").toArrow()
    h, again = K.hashes(top["word"]), K.hashes(top["word"], K.OTHERS)
    order = np.argsort(h)
    table = spark.sparkContext.broadcast((h[order], again[order], *(np.asarray(top[c])[order] for c in ("known", "base", "lp"))))
    narrow_batches(spark)
    kind = "row long, doc_id long, held_out boolean, n long, known long, base double, score double, rest array<binary>"
    # Row numbers are written with the rows and so stay as they are.
    parts = cut(body.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(score_frequent(table), kind), "parts")
    rest = parts.select("row", F.explode("rest").alias("word")).join(scored, "word")
    rest = rest.groupBy("row").agg(F.sum((F.col("c") > 0).cast("long")).alias("known2"), F.sum(term).alias("base2"), F.sum("lp").alias("score2"))
    both = parts.drop("rest").join(rest, "row", "left")
    zero = F.lit(0.0)
    return both.select(
        "doc_id", "held_out", (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("known2", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", zero) + F.lit(math.log10((ends + 0.1) / unit))).alias("base_score"), (F.col("score") + F.coalesce("score2", zero) + F.lit(end_lp)).alias("score"),
    )
