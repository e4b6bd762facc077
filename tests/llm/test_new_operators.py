"""Toxicity, spelling variants and the point-in-time join against brute force, with nulls, ties, repeated rows and empty tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import KIND

from gridpulse.llm import feature_join, spelling_variants, toxicity

# --- point-in-time feature join

VERSION = "source string, event long, arrival long, expiry long, id long, value string, t string"


def asof(versions, source, t):
    usable = [v for v in versions if v[0] is not None and v[0] == source and None not in v[1:3] and v[1] <= t and v[2] <= t and (v[3] is None or t < v[3])]
    return max(usable, key=lambda v: (v[1], v[2], v[4], v[5]), default=None)


@pytest.mark.parametrize("width,per_task", [(16, 7), (1024, 20_000)])
def test_feature_join(spark, width, per_task):
    rng = random.Random(3)
    versions = []
    for i in range(400):
        e = rng.randint(-300, 300)
        life = rng.choice([0, 1, 3, 40, 500])
        versions.append((rng.choice(["a", "a", "a", "b", "ü", None]), e, e + rng.randint(-20, 60), None if i % 9 == 0 else e + life, i // 2, f"v{i % 5}", "x"))
    versions += versions[:20] + [("a", None, 1, 2, 1, "v", "x"), ("a", 1, None, 2, 1, "v", "x")]
    asked = [(rng.choice(["a", "b", "ü", "none", None]), rng.choice([None, *range(-320, 700)])) for _ in range(500)]
    got = feature_join.winners(spark.createDataFrame(versions, VERSION), spark.createDataFrame(asked, "source string, t long"), ["value"], width=width, per_task=per_task).collect()
    got = {(r["source"], r["t"]): (r["event"], r["arrival"], r["id"], r["value"]) for r in got}
    want = {}
    for s, t in asked:
        if s is not None and t is not None and (v := asof(versions, s, t)):
            want[s, t] = (v[1], v[2], v[4], v[5])
    assert got == want and len(want) > 100


def test_spans_cover_once(spark):
    rows = [(a, a + n) for a in (-70, -3, 0, 5, 64) for n in (0, 1, 2, 7, 64, 129)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", feature_join.spans(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        chunks = [c for x in r["s"] for c in range(x["node"] << x["level"], (x["node"] + 1) << x["level"])]
        assert sorted(chunks) == list(range(r["a"], r["b"]))
        assert len(r["s"]) <= 2 * math.ceil(math.log2(r["b"] - r["a"] + 2)) + 1


def test_sweep_matches_scan():
    rng = random.Random(1)
    lo = [rng.randint(0, 3000) for _ in range(1500)]
    hi = [a + rng.randint(0, 900) for a in lo]
    asked = [rng.randint(-5, 4000) for _ in range(300)]
    assert feature_join.sweep(lo, hi, asked) == [max((i for i in range(1500) if lo[i] <= t < hi[i]), default=-1) for t in asked]


def test_label_features(spark):
    docs = [(i, "x", "en" if i % 4 else None, None if i % 7 == 0 else f"s{i % 2}", i, "n", "k") for i in range(3000)]
    docs += [docs[5], (None, "x", "en", "s0", 1, "n", "k")]
    labels = [(i, 0, 0) for i in range(0, 300)] + [(7, 0, 0), (99_999, 0, 0), (None, 0, 0)]
    d, lab = spark.createDataFrame(docs, KIND), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = feature_join.label_features(d, lab).collect()
    import hashlib

    def four(i):
        x = hashlib.sha256(str(i).encode()).hexdigest()
        return [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]

    versions = []
    for r in docs:
        if r[0] is not None:
            a, b, c, _ = four(r[0])
            e = a % 50_000
            versions.append((r[3], e, e - 60 + b % 600, e + c % 900, r[0], r[4], r[2]))
    source = {r[0]: r[3] for r in docs}
    want = []
    for i, _, _ in labels:
        t = None if i is None else four(i)[3] % 50_000
        v = max((v for v in versions if v[0] is not None and v[0] == source.get(i) and v[1] <= t and v[2] <= t < v[3]), key=lambda v: (v[1], v[2], v[4]), default=None) if t is not None else None
        age = t - v[1] if v else None
        status = "none" if v is None else "stale" if age > 120 else "fresh"
        want.append((i, t, v[4] if v else None, age, status, v[5] if status == "fresh" else None, v[6] if status == "fresh" else None))
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {"none", "stale", "fresh"} == {r["status"] for r in got}


def test_feature_join_empty(spark):
    none = spark.createDataFrame([], KIND)
    lab = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert [r["status"] for r in feature_join.label_features(none, lab).collect()] == ["none"]
    assert feature_join.label_features(none, lab.where("false")).count() == 0


# --- spelling variants


def variants_by_hand(counts, ratio=5):
    near = defaultdict(set)
    gone = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            x = w[:k] + w[k + 1 :]
            gone[k, x].add(w)
            if x in counts:
                near[w].add(x)
                near[x].add(w)
    for group in gone.values():
        for a, b in itertools.permutations(group, 2):
            near[a].add(b)
    form = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: f for w, f in form.items() if counts[f] >= ratio * counts[w]}
    out = {}
    for w, n in counts.items():
        end = w
        while end in form:
            end = form[end]
        out[w] = (form.get(w), end, n, len(near[w]), counts[form[w]] if w in form else None)
    return out


@pytest.mark.parametrize("block", [1, 5, 10_000])
def test_variants(spark, block):
    rng = random.Random(block)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 1, 5, 25, 26, 125, 700]) for _ in range(400)}
    counts |= {"aaaaaa": 3, "aaaaa": 15, "aaaa": 75, "x" * 4000: 1, "x" * 3999: 5}
    got = spelling_variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), block=block).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == variants_by_hand(counts) and len(got) == len(counts)


def test_hot_block_is_split(spark):
    """Words that share a first half and, in a hot block, all but one place: every pair is still found once."""
    words = [("prefix" + a + b + "suffix", 5) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame(words, "word string, n long")
    pairs = spelling_variants.near_pairs(df, block=20)
    assert pairs.count() == pairs.distinct().count() == 26 * math.comb(26, 2) * 2


def test_words_of_documents(spark):
    texts = [("Spelling spellinG SPELLING. Ünïcode×÷ naïveté", 1), (None, 2), ("", 3), ("spelling " * 300, 4), ("kürzer1kürzer_kürzer", 5), ("spelling " * 30, 5), ("spelling " * 30, None)]
    rows = [(i, t, "en", "s", 1, "n", "k") for t, i in texts]
    rows += [(1000 + i, "speling variant variants wordforms", "en", "s", 1, "n", "k") for i in range(1200)]
    docs = spark.createDataFrame(rows, KIND)
    counts = Counter()
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    want = variants_by_hand({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = spelling_variants.document_variants(docs).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert spelling_variants.document_variants(docs.where("false")).count() == 0


# --- toxicity


def costs_of(words):
    return toxicity.letter_costs(toxicity.count_trigrams([" ".join(words)]))


def test_trigrams_match_counting():
    text = "Straße, été!\nab1ab  ñandú"
    folded = [toxicity.code(c) for c in f" {text} "]
    flat = [c for i, c in enumerate(folded) if c or i == 0 or folded[i - 1]]
    flat = [x for c in flat for x in ([0, 0] if c == 0 else [c])]
    want = Counter(zip(flat, flat[1:], flat[2:]))
    got = toxicity.count_trigrams([text])
    assert {(a, b, c): n for (a, b, c), n in want.items()} == {(int(i) // 729, int(i) // 27 % 27, int(i) % 27): int(got[i]) for i in np.flatnonzero(got)}


@pytest.mark.parametrize("unit", ["1d10t", "l\x01o\x01s\x01e\x01r", "s-c.u", "looose", "a$$", "i*t", "ß0é", "7x9"])
def test_restore_is_the_cheapest_path(unit):
    costs = costs_of(["idiot", "loser", "scum", "ass", "it", "loose", "toast"] * 20)
    runs = [m for m in re.finditer(r"(.)\1*", unit, re.DOTALL)]

    def cost(choice):
        total, x, y = 0.0, 0, 0
        for text, more in choice:
            total += more
            for c in text:
                z = toxicity.code(c)
                total += costs[(x * 27 + y) * 27 + z]
                x, y = (y, z) if z else (0, 0)
        return total + costs[(x * 27 + y) * 27]

    paths = list(itertools.product(*(toxicity.options(m[1], len(m[0])) for m in runs)))
    best = min(map(cost, paths))
    assert any("".join(t for t, _ in p) == toxicity.restore(unit, costs) and cost(p) == pytest.approx(best) for p in paths)


CLEAN = ["river", "stone", "lamp", "garden", "window", "assess", "ideal", "lost", "close", "scuba"]
RUDE = ["idiot", "loser", "scum"]
DISGUISED = ["1d1ot", "l0ser", "$cum", "i d i o t", "l.o.s.e.r", "looooser", "s-c-u-m", "id!ot", "iddiot", "ID10T!!"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(RUDE)
        elif i % 5 == 0:
            words[3] = rng.choice(["4 a b c 5", "l2:00", "x=3;", "***", "mail@host.net", "AKIA99X", "don't"])
        rows.append((i, " ".join(words), "en", "s", 1, "n", "k"))
        labels.append((i, 1, int(toxic)))
    for k, d in enumerate(DISGUISED):
        rows.append((5000 + k, " ".join([*rng.choices(CLEAN, k=12), d, *rng.choices(CLEAN, k=12)]), "en", "s", 1, "n", "k"))
    rows += [(6000, None, None, None, None, None, None), (6001, "", "en", "s", 0, "n", "k"), (6002, "\x01 \t", "en", "s", 0, "n", "k"), rows[0], (None, "loser", "en", "s", 1, "n", "k"), (6003, "9a" * 50_000 + " stone", "en", "s", 1, "n", "k")]
    labels += [(0, 1, 1), (None, 0, 1), (3, 0, None)]
    return spark.createDataFrame(rows, KIND), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(corpus):
    docs, labels = corpus
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == docs.count()
    by = defaultdict(list)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1)
        by[r["doc_id"]].append(r)
    wrong = [i for i in range(900) if by[i][0]["predicted"] != int(i % 6 == 0)]
    assert not wrong
    assert [d for k, d in enumerate(DISGUISED) if not by[5000 + k][0]["predicted"]] == []
    assert not any(by[i][0]["predicted"] for i in (6000, 6001, 6002, 6003)) and by[None][0]["predicted"] and len(by[0]) == 2


def test_held_out_labels_are_not_used(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    a, b = (sorted(toxicity.judge(docs, x).collect(), key=key) for x in (labels, turned))
    assert [(r["doc_id"], r["score"]) for r in a] == [(r["doc_id"], r["score"]) for r in b]


def test_toxicity_without_labels_or_rows(corpus):
    docs, labels = corpus
    assert {r["score"] for r in toxicity.judge(docs, labels.where("false")).collect()} == {0.5}
    assert toxicity.judge(docs.where("false"), labels).count() == 0


# --- links of a bucket


def test_open_bucket_is_split_into_blocks(spark, monkeypatch):
    """One bucket of ids below the limit to their leaders: every link among them is found in blocks of twenty, none without one."""
    from gridpulse.llm import common

    monkeypatch.setattr(common, "MEET", 20)
    rng = random.Random(21)
    base = list(range(1000, 1060))
    sets = {}
    for i in range(150):
        s = rng.sample(base, 36) + [10_000 + 100 * i + k for k in range(4)]
        sets[i] = s
        if i % 3 == 0:
            sets[1000 + i] = s[:-1] + [7]
    found = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    buckets = spark.createDataFrame([("hot", i) for i in sets] + [("cold", i) for i in list(sets)[:30]], "key string, id long")
    links = {(r["a"], r["b"]) for r in common.class_links(buckets, lambda ids: found.join(ids, "id", "left_semi"), 0.8).collect()}
    alike = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))}
    assert links <= alike and len(alike) >= 50

    def classes(pairs):
        root = {i: i for i in sets}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {i: top(i) for i in sets}

    assert classes(links) == classes(alike)


# --- very long words of the language model


def test_one_long_word(monkeypatch):
    """Depths with few edges, one by one, give what steps over arrays give; a megabyte without a blank ends within seconds."""
    import time

    import pyarrow as pa

    from gridpulse.llm import lm_scoring

    names, logp = lm_scoring.vocabulary()
    lattice = lm_scoring.Lattice(names)
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789+/é") for _ in range(n))
    buf, off = lm_scoring.marked(pa.array([word(k).encode() for k in (3, 900, 1, 40, 0, 2000)], pa.binary()))
    short = lattice.forward(buf, off, logp, back=True)
    monkeypatch.setattr(lm_scoring, "FEW_EDGES", 0)
    plain = lattice.forward(buf, off, logp, back=True)
    assert all(np.allclose(x, y, rtol=1e-9, atol=1e-9) for x, y in zip(short, plain))
    monkeypatch.undo()
    buf, off = lm_scoring.marked(pa.array([word(1_000_000).encode()], pa.binary()))
    began = time.time()
    assert np.isfinite(lattice.forward(buf, off, logp)).all() and time.time() - began < 20
