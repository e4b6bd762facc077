"""Toxicity of documents whose words may be disguised: restore the text, then score it.

Noisy channel: a character language model (trigrams of folded letters, counted over all
documents) and a channel of look-alike characters, separators, blanks between single
letters and repeated letters. A disguised unit is a lattice of what each of its runs may
stand for; Viterbi decoding finds the cheapest spelling. Plain words pass as they are.

The score is learned from labels alone: ``learn`` takes at most ``fit_rows`` labelled rows
(a bounded sample by hash), restores them, and covers the toxic ones greedily by
beginnings of words that rarely stand in the others. A document's score is the noisy-or
of the beginnings it holds, or the rate of toxic documents among those that hold none.

Null and empty texts hold no words and get that rate. Repeated rows score alike; with
several labels the greatest counts. Null ids are scored, and count as empty text in the
hash that holds documents out. Without labels (an empty table) every score is 0.5. Very
long texts are read whole; decoding takes time in proportion to a unit's length. Extra
columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, narrow_batches, release

#: Boundary and 26 letters.
K = 27

# Look-alikes of letters.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
}
#: What may part the letters of a word.
PARTS = "-_.·'/~:,;"
#: Stands for any letter.
ANY = "*#%&?^"
#: Joins single letters that blanks part.
JOIN = "\x01"
LEFT, RIGHT = ".,;:?\"'([{<>%&#*~`^_=+-/\\", ".,;:?\"')]}<>%&#*~`^_=+-/\\!|"

#: Costs (negative logarithms) of the channel: a look-alike, no letter at all, a letter once or twice in a run, a gap closed or kept.
LOOK, NOT_A_LETTER, DROP_ONE, RUN, CLOSED, KEPT, MASK, UNMASK = 1.0, 9.0, 4.0, 0.5, 0.3, 2.5, 3.3, 8.0

#: Words with one beginning count up to this.
MOST = 4

SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
WORD = re.compile(r"[^\W\d_]+")
LONG_RUN = re.compile(r"([^\W\d_])\1\1")
DOUBLE = re.compile(r"(.)\1+")
SPLIT = re.compile("[" + re.escape(PARTS) + "]+")


def folded() -> np.ndarray:
    """Code 1 to 26 of each code point below 0x250 that is a letter of a to z under its accents, else 0."""
    out = np.zeros(0x250, np.uint8)
    for c in range(len(out)):
        base = unicodedata.normalize("NFD", chr(c).lower())[0]
        base = "s" if chr(c) == "ß" else base
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
    return out


FOLD = folded()


def code(c: str) -> int:
    return int(FOLD[ord(c)]) if ord(c) < len(FOLD) else 0


def count_trigrams(texts: Iterable[str]) -> np.ndarray:
    """Counts of trigrams of folded letters; two boundaries part words."""
    out = np.zeros(K**3, np.int64)
    for text in texts:
        c = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
        c = FOLD[np.where(c < len(FOLD), c, 0x20)]
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
        c = np.repeat(c, np.where(c == 0, 2, 1)).astype(np.int64)
        out += np.bincount(c[:-2] * K * K + c[1:-1] * K + c[2:], minlength=K**3)
    return out


def letter_costs(counts: np.ndarray) -> list[float]:
    """Cost of each letter after two others: trigrams over bigrams over letters, each with one unit of weight of the next."""
    n3 = counts.reshape(K, K, K).astype(float)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 1) / (n1.sum() + K)
    p2 = (n2 + 20 * p1[None, :]) / (n2.sum(1, keepdims=True) + 20)
    p3 = (n3 + 20 * p2[None, :, :]) / (n3.sum(2, keepdims=True) + 20)
    return (-np.log(p3)).ravel().tolist()


def options(c: str, k: int) -> list[tuple[str, float]]:
    """What a run of ``k`` characters ``c`` may stand for, with the channel's cost."""
    if c == JOIN:
        return [("", CLOSED), (" ", KEPT)]
    if c in PARTS:
        return [("", LOOK), (" ", LOOK)]
    if c in ANY:
        return [("", UNMASK * k), (" ", UNMASK)] + [(chr(97 + i), MASK * k) for i in range(26)]
    if c in LOOKS:
        once = [(x, LOOK + (0 if k == 1 else RUN)) for x in LOOKS[c]]
        return once + ([(x * 2, LOOK + RUN) for x in LOOKS[c]] if k > 1 else []) + [(" ", NOT_A_LETTER)]
    if not c.isalpha():
        return [(" ", 0.0)]
    if k == 1:
        return [(c, 0.0)]
    return [(c + c, 0.0), (c, DROP_ONE)] if k == 2 else [(c, RUN), (c + c, RUN)]


def restore(unit: str, costs: list[float]) -> str:
    """The cheapest reading of a disguised unit, by Viterbi over the last two letters."""
    beam: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}
    for run in re.finditer(r"(.)\1*", unit, re.DOTALL):
        choice = options(run[1], len(run[0]))
        after: dict[tuple[int, int], tuple] = {}
        for (a, b), (cost, path) in beam.items():
            for text, more in choice:
                x, y, total = a, b, cost + more
                for c in text:
                    z = code(c)
                    total += costs[(x * K + y) * K + z]
                    x, y = (y, z) if z else (0, 0)
                if (held := after.get((x, y))) is None or total < held[0]:
                    after[x, y] = (total, (text, path))
        beam = after
    _, path = min((cost + costs[(a * K + b) * K], n, path) for n, ((a, b), (cost, path)) in enumerate(beam.items()))[::2]
    out = []
    while path is not None:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def units(text: str) -> set[str]:
    """Distinct blank-separated units in lower case; three or more single characters in a row are one unit."""
    text = text.lower()
    return set(SPACED.sub(lambda m: JOIN.join(m[0].split()), text).split())


def read(unit: str, costs: list[float]) -> list[str]:
    """Words of a unit: restored if it looks disguised, else as they stand."""
    unit = unit.lstrip(LEFT).rstrip(RIGHT)
    if unit.isalpha() and not LONG_RUN.search(unit):
        return [unit]
    words = WORD.findall(unit)
    if not words:
        return []
    parts = SPLIT.split(unit)
    if all(p.isalpha() for p in parts) and sum(len(p) == 1 for p in parts) < 2 and not LONG_RUN.search(unit):
        return parts
    return WORD.findall(restore(unit, costs))


def marks(words: Iterable[str]) -> dict[str, int]:
    """The features of a text: beginnings of four to ten letters of its distinct words, with the number of those words up to ``MOST``.

    ``ab`` counts words that begin so, ``ab+`` those that go on after it, ``ab$`` is the word itself.
    """
    out: dict[str, int] = {}
    for word in set(words):
        if len(word) > 2:
            out[word + "$"] = 1
        for k in range(4, min(10, len(word)) + 1):
            b = word[:k]
            out[b] = min(out.get(b, 0) + 1, MOST)
            if k < len(word):
                out[b + "+"] = min(out.get(b + "+", 0) + 1, MOST)
    return out


@dataclass
class Model:
    """Letter costs, the lexicon (beginning: probability by the number of words with it) and the rate of documents that hold nothing of it."""

    costs: list[float]
    lexicon: dict[str, list[float]] = field(default_factory=dict)
    rate: float = 0.5

    def __post_init__(self) -> None:
        self.memo: dict[str, frozenset[str]] = {}
        self.flat = {DOUBLE.sub(r"\1", b) for b in self.lexicon}

    def telling(self, unit: str) -> frozenset[str]:
        """Words of a unit that begin with an entry of the lexicon; a doubled letter is decoded only where an entry may be behind it."""
        held = self.memo.get(unit)
        if held is None:
            words = read(unit, self.costs)
            for w in list(words):
                single = DOUBLE.sub(r"\1", w)
                if single != w and not self.flat.isdisjoint(marks([single])):
                    words += WORD.findall(restore(w, self.costs))
            held = frozenset(w for w in words if not self.lexicon.keys().isdisjoint(marks([w])))
            if len(self.memo) >= 500_000:
                self.memo.clear()
            self.memo[unit] = held
        return held

    def score(self, text: str | None) -> float:
        found: set[str] = set()
        for unit in units(text or ""):
            found |= self.telling(unit)
        if not found:
            return self.rate
        clean = 1.0
        for b, n in sorted(marks(found).items()):
            if b in self.lexicon:
                clean *= 1 - self.lexicon[b][n - 1]
        return max(1 - clean, self.rate)


def character_model(docs: DataFrame) -> list[float]:
    """Letter costs from all texts; each task hands on at most 27 ** 3 counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(K**3, np.int64)
        for b in batches:
            total += count_trigrams(b["text"])
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    grams = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(K**3, np.int64)
    for r in grams.collect():  # at most 27 ** 3 rows
        counts[r["gram"]] = r["n"]
    return letter_costs(counts)


Mark = tuple[str, int]


def cover(held: dict[Mark, set[int]], counts: dict[Mark, tuple[int, int]], least: int, again: int, times: int = 3) -> list[Mark]:
    """Features in greedy order: most documents not yet covered less those that are not toxic, then the longer beginning.

    Documents are covered up to ``times``: features that add ``least`` documents cover them first, those
    that add ``again`` cover them further. None begins like one that is already chosen.
    """
    rank = lambda f, n: (counts[f][1] - counts[f][0] - n, f[0][-1] in "$+", -len(f[0]), f, n)
    covered: dict[int, int] = {}
    chosen: list[Mark] = []
    stems: list[str] = []
    for turn in range(times):
        heap = [rank(f, len(d)) for f, d in held.items() if f not in chosen]
        heapq.heapify(heap)
        while heap:
            f = heapq.heappop(heap)[3]
            stem = f[0].rstrip("$+")
            if any(stem.startswith(x) or x.startswith(stem) for x in stems):
                continue
            now = rank(f, sum(covered.get(d, 0) <= turn for d in held[f]))
            if now[4] < (again if turn else least):
                continue
            if heap and now > heap[0]:
                heapq.heappush(heap, now)
                continue
            chosen.append(f)
            stems.append(stem)
            for d in held[f]:
                covered[d] = covered.get(d, 0) + 1
    return chosen


def learn(docs: DataFrame, labels: DataFrame, costs: list[float], fit_rows: int = 8_000, least: int = 3, again: int = 8, exact: float = 0.8, prior: float = 2.0) -> Model:
    """The lexicon from at most about ``fit_rows`` rows of ``labels`` (``doc_id, toxic``).

    A beginning, with a number of words that have it, is in question if at least ``least``
    toxic documents hold it and ``exact`` of all that hold it are toxic; ``cover`` chooses. ``prior`` documents at the overall rate are added to each count.
    """
    own = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n, toxic = own.agg(F.count("*"), F.sum("toxic")).first()
    if not n:
        return Model(costs)
    base = toxic / n
    if n > fit_rows:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * fit_rows / n)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [sorted(marks(w for u in units(t) for w in read(u, costs)).items()) for t in b["text"]]
            yield pd.DataFrame({"doc": b["doc"], "toxic": b["toxic"], "marks": [[m for m, _ in f] for f in found], "ns": [[n for _, n in f] for f in found]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The sample is bounded by fit_rows; rows with one id count apart.
    rows = texts.join(F.broadcast(own), "doc_id").select(F.monotonically_increasing_id().alias("doc"), "toxic", "text")
    rows = cut(rows.mapInPandas(run, "doc long, toxic int, marks array<string>, ns array<int>"), "labelled")
    held_by = rows.select("doc", "toxic", F.inline(F.arrays_zip(F.col("marks").alias("mark"), F.col("ns").alias("n"))))
    held_by = held_by.select("doc", "toxic", "mark", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("n"))
    counts = cut(held_by.groupBy("mark", "n").agg(F.sum("toxic").alias("t"), F.count("*").alias("docs")).where(F.col("t") >= least), "marks")
    asked = counts.where(F.col("t") >= exact * F.col("docs"))
    held: dict[Mark, set[int]] = {}
    seen: dict[Mark, tuple[int, int]] = {}
    for r in held_by.where("toxic = 1").join(asked, ["mark", "n"]).toLocalIterator():  # beginnings of words of a bounded sample
        held.setdefault((r["mark"], r["n"]), set()).add(r["doc"])
        seen[r["mark"], r["n"]] = (r["t"], r["docs"])
    chosen = cover(held, seen, least, again)
    lexicon = {}
    # Of documents with exactly so many words of a beginning, drawn to the rate of all that have one.
    for r in counts.where(F.col("mark").isin(sorted({m for m, _ in chosen}))).groupBy("mark").agg(F.sort_array(F.collect_list(F.struct("n", "t", "docs"))).alias("c")).collect():
        at_least = {n: (t, d) for n, t, d in r["c"]}
        overall = (at_least[1][0] + prior * base) / (at_least[1][1] + prior)
        exactly = [[at_least.get(k, (0, 0))[i] - at_least.get(k + 1, (0, 0))[i] for i in (0, 1)] for k in range(1, MOST + 1)]
        p = [(t + prior * overall) / (d + prior) for t, d in exactly]
        lexicon[r["mark"]] = np.maximum.accumulate(p).tolist()
    n, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    rest = (toxic or 0) - len(set().union(*(held[f] for f in chosen)))
    missed = n - (toxic or 0) + rest
    release(rows, counts)
    return Model(costs, lexicon, (rest + prior * base) / (missed + prior))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, 0 to 1."""

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        return text.map(model.score)

    return docs.withColumn("score", run("text"))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fit_rows: int = 8_000) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``; labels of held-out ids are not used."""
    narrow_batches(docs.sparkSession)
    model = learn(docs, labels.where(~held_out()), character_model(docs), fit_rows)
    out = scores(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
