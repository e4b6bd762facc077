"""N-best segmentation over a SentencePiece vocabulary.

A text becomes chunks that no piece of the vocabulary crosses: each run of blanks
(word marks) with what follows up to the next blank; pieces with a mark after
another character would cross, but the vocabulary has only runs of marks. A line
feed that no longer piece holds is a chunk of its own. A chunk's lattice is searched forward by Viterbi; those scores are exact heuristics
for a backward A* search, which yields segmentations best first. States point back
to their parents, and a place is opened at most n times, since only its n best
ends can take part, so a chunk of L characters costs at most n * L steps whatever its
ties. The most frequent chunks of all texts are counted, searched once, spread over
the cluster, and handed to every worker (at most ``SHARED``, which bounds that broadcast;
whether a chunk is among them changes no result). Others are remembered; the new ones of a batch are searched together, by the
same scores from both ends: the best segmentation is made of the pieces that lose
nothing, and the second loses what the best of all other pieces does. Segmentations of a text combine those of its chunks, which are
independent: only the n - 1 chunks whose second choice loses least can take part in
the n best.

Decoding joins pieces and turns marks back into blanks; it returns the text as it
was (a mark in the text itself comes back as a blank).

Defined cases: null text encodes as the empty text and has one segmentation, of
one mark; equal scores rank fewer pieces first; within a chunk then the longer first
piece, and so on from piece to piece; between chunks then, at the first chunk in which
two segmentations differ, the better one of that chunk. Rows are independent, so
repeated rows repeat their result; extra columns pass, but ``scores`` and ``pieces`` are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import cut, narrow_batches, release
from .lm_scoring import Lattice

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
#: Chunks that a worker remembers; the older half goes when it is full.
REMEMBERED = 600_000
#: At most so many frequent chunks, of at most 64 characters, are searched once and broadcast.
SHARED = 300_000
#: Totals nearer than this are compared by the rules for equal scores.
TIE = 1e-6
MARK = "▁"
#: Scores below this mark pieces that never win; bytes cost less than those and more than all others.
UNUSED = -1e6
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: A segmentation: score, number of pieces, ids as four-byte integers.
Path_ = tuple[float, int, bytes]
#: What is remembered of a chunk: best score, its pieces, what the second best loses, whether it decodes to the chunk.
Best = tuple[float, bytes, float, bool]
INF = float("inf")


def longest(a: np.ndarray, b: np.ndarray, depth: np.ndarray, w: np.ndarray, nodes: int, roots: np.ndarray) -> np.ndarray:
    """Best scores of paths from the roots along edges from a to b, edge by edge in order of depth of the far end."""
    out = np.full(nodes, -np.inf)
    out[roots] = 0.0
    order = np.argsort(depth, kind="stable")
    a, b, depth, w = a[order], b[order], depth[order], w[order]
    cuts = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1]]) if len(depth) else np.zeros(0, np.int64)
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(depth)]):
        np.maximum.at(out, b[lo:hi], out[a[lo:hi]] + w[lo:hi])
    return out


class Pieces:
    """The vocabulary as a trie, with the best segmentations of recent chunks."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=str(Path(path)))
        self.names: list[str] = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes: dict[int, int] = {}
        self.trie: dict = {}
        low = 0.0
        for i, name in enumerate(self.names):
            if sp.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if MARK in name.lstrip(MARK):
                    raise ValueError(f"{name!r} crosses chunks")
                node = self.trie
                for c in name:
                    last = node.setdefault(c, [{}, None])
                    node = last[0]
                score = sp.get_score(i)
                last[1] = (score, 1, i.to_bytes(4, "little"))
                if score > UNUSED:
                    low = min(low, score)
        self.byte_score = low - 10.0
        own = [i for i, name in enumerate(self.names) if i not in self.bytes and not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = Lattice([self.names[i].encode() for i in own])
        self.ids, self.scores = np.array(own), np.array([sp.get_score(i) for i in own])
        #: A line feed in no piece of several characters is a chunk of its own.
        self.lone = not any("\n" in x for x in self.names if len(x) > 1)
        self.byte_ids = np.array([self.bytes.get(b, 0) for b in range(256)])
        values = {i: v for v, i in self.bytes.items()}
        #: What each piece stands for in UTF-8.
        self.raw = [bytes([values[i]]) if i in values else name.encode() for i, name in enumerate(self.names)]
        self.raw_size = np.array([len(x) for x in self.raw])
        self.source: str | None = None
        self.shared: dict[str, Best] = {}
        self.new: dict[str, Best] = {}
        self.old: dict[str, Best] = {}
        self.spare: dict[str, int] = {}
        self.many: dict[tuple[str, int], list[Path_]] = {}

    def lattice(self, chunk: str) -> tuple[list[list[tuple[int, float, int, bytes]]], list[float], list[int]]:
        """For each end: start, score, count and pieces of the arcs that end there; best score and then least count up to it.

        A character without a piece is its bytes. Arcs lead onward, so a place's
        score is final when arcs from it are drawn.
        """
        size = len(chunk)
        out: list[list[tuple[int, float, int, bytes]]] = [[] for _ in range(size + 1)]
        forward, count = [0.0] + [-INF] * size, [0] * (size + 1)
        for i in range(size):
            here, n, node, own = forward[i], count[i] + 1, self.trie, False
            for j in range(i + 1, size + 1):
                if (step := node.get(chunk[j - 1])) is None:
                    break
                node, hit = step
                if hit is not None:
                    out[j].append((i, *hit))
                    total = here + hit[0]
                    if total > forward[j] or total == forward[j] and n < count[j]:
                        forward[j], count[j] = total, n
                    own = own or j == i + 1
            if not own:
                raw = [self.bytes[b] for b in chunk[i].encode()]
                s = self.byte_score * len(raw)
                out[i + 1].append((i, s, len(raw), b"".join(x.to_bytes(4, "little") for x in raw)))
                n += len(raw) - 1
                if here + s > forward[i + 1] or here + s == forward[i + 1] and n < count[i + 1]:
                    forward[i + 1], count[i + 1] = here + s, n
        return out, forward, count

    def best(self, chunk: str, n: int) -> list[Path_]:
        """The n best segmentations, best first."""
        arcs, forward, count = self.lattice(chunk)
        size = len(chunk)
        # Less its exact total, count, place (ties open from the end, so that all that can lead to a place come before it),
        # end of its first piece (longer first), rank of what follows among the ends at that place; then score, count, state behind, pieces.
        heap: list[tuple] = [(-forward[size], count[size], -size, 0, 0, 0.0, 0, None, b"")]
        opened = [0] * (size + 1)
        found: list[Path_] = []
        while heap and len(found) < n:
            state = heapq.heappop(heap)
            j, back, used = -state[2], state[5], state[6]
            rank = opened[j]
            if rank == n:
                continue
            opened[j] = rank + 1
            if j == 0:
                pieces = []
                while state is not None:
                    pieces.append(state[8])
                    state = state[7]
                found.append((back, used, b"".join(pieces)))
                continue
            for i, s, c, p in arcs[j]:
                heapq.heappush(heap, (-(forward[i] + s + back), count[i] + c + used, -i, -j, rank, s + back, used + c, state, p))
        return found

    def first(self, chunk: str) -> Best:
        """The search up to its first result, and what the second will lose.

        The states it opens along the best segmentation carry exact totals, so the
        least loss among those left open is the second's. Ties are left to ``best``.
        """
        arcs, forward, _ = self.lattice(chunk)
        j, back, loss = len(chunk), 0.0, INF
        used: list[bytes] = []
        while j:
            least = rest = INF
            here = forward[j]
            for arc in arcs[j]:
                short = here - (forward[arc[0]] + arc[1])
                if short < least:
                    least, rest, via = short, least, arc
                elif short < rest:
                    rest = short
            if rest < loss:
                loss = rest
            j, s, _, p = via
            back += s
            used.append(p)
        if loss < TIE:
            return self.tied(chunk)
        used.reverse()
        pieces = b"".join(used)
        return back, pieces, loss, self.join(pieces) == chunk.encode()

    def tied(self, chunk: str) -> Best:
        """``first`` of a chunk by the full search."""
        two = self.ranked(chunk, 2)
        back, _, pieces = two[0]
        return back, pieces, back - two[1][0] if len(two) > 1 else INF, self.join(pieces) == chunk.encode()

    def recall(self, chunk: str) -> Best:
        """``first`` of a chunk, remembered."""
        if (hit := self.old.get(chunk)) is None:
            hit = self.first(chunk)
        if len(self.new) >= REMEMBERED // 2:
            self.old, self.new, self.spare = self.new, {}, {}
        if len(chunk) <= 64:
            self.new[chunk] = hit
        return hit

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Chunks of the texts; those that are new and short are searched together and remembered."""
        parts = [self.chunks(x) for x in texts]
        new = set(itertools.chain.from_iterable(parts)).difference(self.shared).difference(self.new).difference(self.old)
        new = {c for c in new if len(c) <= 64}
        if len(self.new) + len(new) > REMEMBERED // 2:
            new |= {c for x in parts for c in x if c in self.old}
            self.old, self.new, self.spare, self.many = self.new, {}, {}, {}
        if new:
            words = list(new)
            self.new.update(zip(words, self.firsts(words)))
        return parts

    def firsts(self, words: list[str]) -> list[Best]:
        """``first`` of many chunks."""
        return [self.tied(c) if hit is None else hit for c, hit in zip(words, self.together(words))]

    def together(self, words: list[str]) -> list[Best | None]:
        """``first`` of many chunks at once; None where two segmentations are equally good."""
        buf, off = K.buffers(pa.array(words, pa.string()))
        buf, off = buf[off[0] : off[-1]], off - off[0]
        start, end, piece = self.pieces.edges(buf, off)
        # A character without a piece of its own is its bytes.
        char = np.r_[np.flatnonzero((buf & 0xC0) != 0x80), len(buf)]
        has = np.zeros(len(buf) + 1, bool)
        size = np.zeros(len(buf) + 1, np.int64)
        size[char[:-1]] = np.diff(char)
        has[start[end - start == size[start]]] = True
        lone = char[:-1][~has[char[:-1]]]
        score = np.r_[self.scores[piece], self.byte_score * size[lone]]
        start, end, piece = np.r_[start, lone], np.r_[end, lone + size[lone]], np.r_[self.ids[piece], np.full(len(lone), -1)]
        word = np.searchsorted(off, start, "right") - 1
        node, to = start + word, end + word
        nodes, order = len(buf) + len(words), np.arange(len(words))
        ahead = longest(node, to, end - off[word], score, nodes, off[:-1] + order)
        behind = longest(to, node, off[word + 1] - start, score, nodes, off[1:] + order)
        total = ahead[off[1:] + order]
        loss = total[word] - (ahead[node] + score + behind[to])
        on = loss < TIE
        second = np.full(len(words), np.inf)
        np.minimum.at(second, word[~on], loss[~on])
        single = np.bincount(word[on], (end - start)[on], len(words)) == np.diff(off)
        path = np.flatnonzero(on)
        path = path[np.argsort(start[path], kind="stable")]
        count = np.where(piece[path] < 0, (end - start)[path], 1)
        at = np.repeat(start[path] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        every = np.where(np.repeat(piece[path] < 0, count), self.byte_ids[buf[np.minimum(at, len(buf) - 1)]], np.repeat(piece[path], count)).astype("<i4")
        # Words with one best segmentation decode to themselves if their pieces do one after another and fill each word.
        of = np.repeat(word[path], count)
        filled = np.bincount(of, self.raw_size[every], len(words))[single] == np.diff(off)[single]
        right = bool(filled.all()) and self.join(every[single[of]].tobytes()) == buf[np.repeat(single, np.diff(off))].tobytes()
        ids = every.tobytes()
        ends = (4 * np.r_[0, np.cumsum(np.bincount(word[path], count, len(words)))]).astype(np.int64).tolist()
        return [(t, ids[a:b], x, right or self.join(ids[a:b]) == w.encode()) if ok else None for w, t, x, ok, a, b in zip(words, total.tolist(), second.tolist(), single.tolist(), ends, ends[1:])]

    def more(self, chunk: str) -> int:
        """Pieces that the second best segmentation of a chunk has more than the best."""
        if (hit := self.spare.get(chunk)) is None:
            one, two = self.ranked(chunk, 2)
            hit = two[1] - one[1]
            if len(chunk) <= 64 and len(self.spare) < REMEMBERED:
                self.spare[chunk] = hit
        return hit

    def ranked(self, chunk: str, n: int) -> list[Path_]:
        """``best`` of a chunk, remembered."""
        if (hit := self.many.get((chunk, n))) is None:
            hit = self.best(chunk, n)
            if len(chunk) <= 64 and len(self.many) < REMEMBERED // 8:
                self.many[chunk, n] = hit
        return hit

    def chunks(self, text: str) -> list[str]:
        if "  " in text or MARK in text or text[:1] == " ":
            parts = CHUNK.findall(MARK + text.replace(" ", MARK))
        elif self.lone and "\n" in text:
            return [x for x in (MARK + text.replace(" ", f" {MARK}").replace("\n", " \n ")).split(" ") if x]
        else:
            return (MARK + text.replace(" ", f" {MARK}")).split(" ")
        if not self.lone or "\n" not in text:
            return parts
        out: list[str] = []
        for x in parts:
            if "\n" in x:
                out += [y for y in re.split("(\n)", x) if y]
            else:
                out.append(x)
        return out

    def search(self, text: str, n: int, chunks: list[str] | None = None) -> tuple[list[Path_], bool]:
        """The n best segmentations of a whole text, and whether the best decodes to it."""
        chunks = self.chunks(text) if chunks is None else chunks
        got = list(map(self.shared.get, chunks))
        if None in got:
            known, recall = self.new.get, self.recall
            got = [hit or known(c) or recall(c) for hit, c in zip(got, chunks)]
        scores, parts, losses, good = zip(*got)
        first = b"".join(parts)
        total, size, decodes = float(sum(scores)), len(first) // 4, all(good)
        lost = np.array(losses)
        least = (np.sort(np.partition(lost, n - 2)[: n - 1]) if len(lost) >= n > 1 else np.sort(lost)[: n - 1]).tolist()
        if not least or least[0] == INF:
            return [(total, size, first)], decodes
        most = min(least[-1], 1e300)
        weak = np.flatnonzero(lost <= most).tolist()
        if len(weak) >= n:
            weak = sorted(weak, key=lambda k: (losses[k], self.more(chunks[k]), -k))[: n - 1]
        # Combinations: loss, pieces more, ranks by chunk from the first on; least first.
        sums: list[tuple[float, int, tuple[int, ...]]] = [(0.0, 0, ())]
        weak.sort()
        options = [self.ranked(chunks[k], n) for k in weak]
        for paths in options:
            s0, c0, _ = paths[0]
            sums = sorted([(loss + s0 - s, more + c - c0, (*use, q)) for loss, more, use in sums for q, (s, c, _) in enumerate(paths)])[:n]
        starts, at, last = [], 0, 0
        for k in weak:
            at, last = at + sum(map(len, parts[last:k])), k
            starts.append(at)
        out = []
        for loss, more, use in sums:
            pieces, at = [], 0
            for k, q, start, paths in zip(weak, use, starts, options):
                if q:
                    pieces += [first[at:start], paths[q][2]]
                    at = start + len(parts[k])
            out.append((total - loss, size + more, b"".join([*pieces, first[at:]])))
        return out, decodes

    def encode(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """Scores and pieces of the n best segmentations of a whole text."""
        return [(s, np.frombuffer(p, "<i4").tolist()) for s, _, p in self.search(text, n)[0]]

    def join(self, pieces: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, memoryview(pieces).cast("i")))

    def decode(self, pieces: list[int] | tuple[int, ...]) -> str:
        return b"".join(map(self.raw.__getitem__, pieces)).decode(errors="replace").replace(MARK, " ")[1:]


_loaded: dict[str, Pieces] = {}


def pieces(path: str = PIECES) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


ENCODED = "scores array<double>, pieces array<array<int>>"
DIGEST = "n_pieces long, scores array<double>, pieces_sha256 array<string>, decodes boolean"


def chunk_counts(docs: DataFrame) -> DataFrame:
    """``chunk, n`` of ``text``, for chunks after a single blank or a line feed; others are not worth knowing beforehand."""
    word = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("w")).where(F.length("w") < 64)
    plain = word.where(~F.contains("w", F.lit("\n"))).groupBy("w").agg(F.count("*").alias("n")).select(F.concat(F.lit(MARK), "w").alias("chunk"), "n")
    parts = word.where(F.contains("w", F.lit("\n"))).select(F.posexplode(F.split("w", "\n")).alias("i", "w")).where("w <> ''")
    broken = parts.groupBy(F.when(F.col("i") == 0, F.concat(F.lit(MARK), "w")).otherwise(F.col("w")).alias("chunk")).agg(F.count("*").alias("n"))
    return plain.union(broken).groupBy("chunk").agg(F.sum("n").alias("n"))


BEST = "chunk string, score double, pieces binary, loss double, decodes boolean"


def frequent(docs: DataFrame, path: str, most: int = SHARED) -> list[tuple[str, Best]]:
    """The most frequent chunks that occur twice or more, with what ``first`` says of each: all above a count, which leaves at most ``most``."""
    counts = cut(chunk_counts(docs).where("n > 1"), "chunks")
    # Chunks by count on a coarse scale, some hundred rows: the least step with at most ``most`` chunks from it on.
    step = F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = sorted(((r["s"], r["k"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()), reverse=True)
    total, least = 0, None
    for s, k in sizes:
        total += k
        if total > most:
            break
        least = s
    if least is None:
        release(counts)
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pieces(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            cols = list(zip(*held.firsts(words))) if words else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())], names=["chunk", "score", "pieces", "loss", "decodes"])

    found = counts.where(step >= least).select("chunk").mapInArrow(run, BEST).toArrow()
    release(counts)
    return list(zip(found["chunk"].to_pylist(), zip(*(found[c].to_pylist() for c in ("score", "pieces", "loss", "decodes")))))


def encoder(path: str, n: int, digest: bool, column: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pieces(path)
        if held.source != shared.value[0]:
            held.source, held.shared = shared.value[0], dict(shared.value[1])
        kinds = [("n_pieces", pa.int64()), ("scores", pa.list_(pa.float64())), ("pieces_sha256", pa.list_(pa.string())), ("decodes", pa.bool_())] if digest else [("scores", pa.list_(pa.float64())), ("pieces", pa.list_(pa.list_(pa.int32())))]
        for batch in batches:
            rows = []
            texts = [text or "" for text in batch.column(column).to_pylist()]
            for text, chunks in zip(texts, held.learn(texts)):
                best, decodes = held.search(text, n, chunks)
                if digest:
                    rows.append((best[0][1], [s for s, _, _ in best], [hashlib.sha256(p).hexdigest() for _, _, p in best], decodes))
                else:
                    rows.append(([s for s, _, _ in best], [np.frombuffer(p, "<i4") for _, _, p in best]))
            cols = list(zip(*rows)) if rows else [[]] * len(kinds)
            keep = [i for i in range(batch.num_columns) if not (digest and i == column)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *(pa.array(c, k) for c, (_, k) in zip(cols, kinds))], names=[*(batch.schema.names[i] for i in keep), *(x for x, _ in kinds)])

    return run


def handed(docs: DataFrame, path: str):
    """``frequent`` chunks as a broadcast, under a name of their own."""
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, frequent(docs.select("text"), path)))


def encode(docs: DataFrame, n: int = N_BEST, path: str = PIECES) -> DataFrame:
    """``docs`` with ``scores`` and ``pieces`` of the n best segmentations of ``text``."""
    narrow_batches(docs.sparkSession)
    docs = docs.drop("scores", "pieces")
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(ENCODED).fields)
    return docs.mapInArrow(encoder(path, n, False, docs.columns.index("text"), handed(docs, path)), schema)


def encode_digests(docs: DataFrame, n: int = N_BEST, path: str = PIECES) -> DataFrame:
    """``doc_id`` with the number of pieces of the best, all n scores, hashes of the n piece lists, and whether the best decodes to the text."""
    narrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encoder(path, n, True, 1, handed(docs, path)), f"doc_id long, {DIGEST}")


def decode(encoded: DataFrame, path: str = PIECES) -> DataFrame:
    """``doc_id, text`` from ``doc_id, pieces`` (the best list of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pieces(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([held.decode(p[0]) if p else "" for p in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")
