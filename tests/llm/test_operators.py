"""Each operator against brute force on small tables with nulls, empty and repeated texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import bag_minhash, common, exact_dedup, kernels, license_scan, line_dedup, lm_scoring, mixing, piece_nbest, quality_rules, substring_dedup, suffix_dedup

KIND = "doc_id long, text string, lang string, source string, n_chars long, node string, key string"
SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "é", "ß"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [sentence(rng, rng.randint(20, 120)) for _ in range(40)]
    passage = sentence(rng, 90)
    out += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 40) for _ in range(6)]
    near = passage.split()
    near[45] = "changed"
    out += [sentence(rng, 20) + "\n" + " ".join(near)]
    out += [out[3], out[3].replace(" ", "  "), out[3], out[4] + " extra"]
    out += ["", None, " \t\n", "a", "x" * 900, "ab " * 400, "one two three\none two three\none two three four", "Licensed under the Apache License, Version 2.0.\n" + sentence(rng, 60)]
    out += ["no\tspaces\x0bhere\x0c\r\nend 你好世界 " + sentence(rng, 10)]
    return [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, "n", "k") for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def test_words_match_pattern(rows):
    import pyarrow as pa

    col = pa.array([r[1] for r in rows])
    buf, off = kernels.buffers(col)
    s, e, row, h = kernels.words(buf, off)
    got = defaultdict(list)
    for a, b, r in zip(s, e, row):
        got[r].append(bytes(buf[a:b]).decode())
    for i, r in enumerate(rows):
        assert got[i] == WORDS.findall(r[1] or "")
    assert len({bytes(buf[a:b]) for a, b in zip(s, e)}) == len(set(h.tolist()))


def test_lm_scores(docs, rows, empty):
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, frequent=20).collect()}
    assert len(got) == len(rows)
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    tokens = {r[0]: WORDS.findall(lower(r[1])) + [None] for r in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    count = Counter(t for d, ts in tokens.items() if not held[d] for t in ts)
    n, v = sum(count.values()), len(count)
    for d, ts in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(ts), sum(count[t] > 0 for t in ts), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lm_scoring.score(empty).count() == 0
    twice = lm_scoring.score(docs.where("doc_id in (40, 41)").unionAll(docs.where("doc_id = 41"))).collect()
    assert sorted(r["doc_id"] for r in twice) == [40, 41, 41] and len({r["score"] for r in twice if r["doc_id"] == 41}) == 1


def test_lm_model_by_hand(spark):
    """The whole model over a vocabulary's lattice in plain Python: counts, three rounds of re-estimation, scores."""
    names, logp = lm_scoring.vocabulary()
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "theory", "one", "on", "Tone", "é"]) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    count = Counter(w for i, t in rows if not held[i] for w in t.lower().split())
    ends = sum(not x for x in held.values())
    index = {x: k for k, x in enumerate(names)}

    def parts(word, p):
        """Marginal and expected pieces of a word, over all its segmentations."""
        x, ways = "▁".encode() + word.encode(), []

        def walk(at, used, q):
            if at == len(x):
                ways.append((q, used))
            for end in range(at + 1, len(x) + 1):
                if x[at:end] in index:
                    walk(end, used + [index[x[at:end]]], q * p[index[x[at:end]]])

        walk(0, [], 1.0)
        total = sum(q for q, _ in ways)
        expected = Counter()
        for q, used in ways:
            for k in used:
                expected[k] += q / total
        return total, expected

    p, likely = np.exp(logp), []
    for _ in range(lm_scoring.ROUNDS):
        got = np.full(len(p), 0.01)
        likely.append(sum(c * math.log(parts(w, p)[0]) for w, c in count.items()))
        for w, c in count.items():
            for k, n in parts(w, p)[1].items():
                got[k] += c * n
        p, end = got / (got.sum() + ends), ends / (got.sum() + ends)
    likely.append(sum(c * math.log(parts(w, p)[0]) for w, c in count.items()))
    assert likely == sorted(likely)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for r in lm_scoring.score(table, frequent=3).collect():
        words = rows[r["doc_id"]][1].lower().split()
        assert r["score"] == pytest.approx(sum(math.log10(parts(w, p)[0]) for w in words) + math.log10(end), rel=1e-9)
    # Words that only held-out rows have train nothing.
    other = [(i, t + " zebra" if held[i] else t) for i, t in rows]
    changed = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(other, "doc_id long, text string")).collect() if not r["held_out"]}
    assert changed == pytest.approx({r["doc_id"]: r["score"] for r in lm_scoring.score(table).collect() if not r["held_out"]}, rel=1e-9)


def test_lm_lattice_sums_all_segmentations():
    names, logp = [b"\xe2\x96\x81a", b"\xe2\x96\x81", b"a", b"b", b"ab", b"\xe2\x96\x81ab"], np.log(np.array([0.1, 0.2, 0.1, 0.3, 0.2, 0.1]))
    import pyarrow as pa

    buf, off = lm_scoring.marked(pa.array([b"ab", b"aab", b"z"]))
    total, word, post, piece = lm_scoring.Lattice(names).forward(buf, off, logp, back=True)
    p = dict(zip(names, np.exp(logp)))

    def all_of(x):
        return 1.0 if not x else sum(q * all_of(x[len(m) :]) for m, q in p.items() if x.startswith(m))

    for w, t in zip((b"ab", b"aab"), total):
        assert math.exp(t) == pytest.approx(all_of(b"\xe2\x96\x81" + w))
    assert total[2] == -math.inf
    # Posterior lengths of pieces add up to the word.
    assert np.bincount(word, post * np.array([len(names[i]) for i in piece]))[:2] == pytest.approx([5, 6])


def jaccard5(x, y):
    s = lambda t: {t[i : i + 5] for i in range(len(t) - 4)} or {t}
    a, b = s(x.lower()), s(y.lower())
    return len(a & b) / len(a | b)


def union(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in nodes}


def test_lines(docs, rows, empty):
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_classes(docs).collect()}
    own = {(r[0], k): x.strip(" \t\r\x0b\x0c") for r in rows for k, x in enumerate((r[1] or "").split("\n"))}
    own = {k: x for k, x in own.items() if x}
    assert got == union(own, [(a, b) for a in own for b in own if a < b and jaccard5(own[a], own[b]) >= 0.8])
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert out[next(r[0] for r in rows if r[1] and r[1].startswith("one two"))]["text"].count("one two three") <= 2
    assert set(out) <= {r[0] for r in rows} and line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.line_classes(empty).count() == 0


def test_passages(docs, rows, empty):
    got = substring_dedup.repeated_passages(docs).collect()
    linked = {x for r in got for x in (r["doc_id"], r["partner_id"])}
    texts = {r[0]: WORDS.findall(r[1] or "") for r in rows}
    grams = {d: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] for d, w in texts.items()}

    def alike(a, b):
        x, y = grams[a], grams[b]
        return any(len(set(x[i : i + 46]) & set(y[j : j + 46])) >= 0.8 * len(set(x[i : i + 46]) | set(y[j : j + 46])) for i in range(len(x) - 45) for j in range(len(y) - 45) if x[i + 20] in y[j : j + 46])

    held = [(a, b) for a in grams for b in grams if a < b and set(grams[a]) & set(grams[b]) and alike(a, b)]
    assert union(grams, [(r["partner_id"], r["doc_id"]) for r in got]) == union(grams, held)
    assert linked == {x for e in held for x in e}
    for r in got:
        assert r["end_word"] - r["start_word"] >= 50
        mine, other = (set(grams[d][s : e - 4]) for d, s, e in ((r["doc_id"], r["start_word"], r["end_word"]), (r["partner_id"], r["partner_start"], r["partner_end"])))
        if r["kind"] == "passage":
            assert r["similarity"] == pytest.approx(len(mine & other) / len(mine | other)) and r["similarity"] >= 0.8
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_passages_behind_a_notice(spark):
    """A notice connects three texts; what two of them share behind it, in a bucket that the third leads, is compared too."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    notice, shared = words(60), words(55)
    rows = [(k, " ".join(notice + words(70 + 9 * (k == 2)) + (shared if k else words(55)))) for k in range(3)]
    body = spark.createDataFrame(rows, "doc_id long, text string")
    members = [(key, k, c + 9 * (k == 2 and key), 0) for key, c in ((0, 3), (1, 133)) for k in range(3)]
    members = common.cut(spark.createDataFrame(members, "key long, id long, c int, sketch long"), "members")
    got = substring_dedup.met_passages(members, body, 46, 0.8, 10).collect()
    assert {(r["a"], r["b"], r["a_start"], r["b_start"], r["similarity"]) for r in got if r["a_start"] > 60} == {(1, 2, 130, 139, 1.0)}


def test_passage_recall(spark):
    """Planted passages of 50 to 120 words, exact and edited, each in two texts of their own."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "li", "so"]) for _ in range(rng.randint(2, 5)))
    table, near, exact = [], [], []
    for k in range(200):
        passage = [word() for _ in range(rng.randint(50, 120))]
        other = list(passage)
        for _ in range(0 if k % 2 else max(1, len(passage) // 55)):
            other[rng.randrange(3, len(other) - 3)] = word() + "x"
        x, y = ({tuple(p[i : i + 5]) for i in range(len(p) - 4)} for p in (passage, other))
        if len(x & y) < 0.8 * len(x | y):
            continue
        (exact if k % 2 else near).append(2 * k + 1)
        for d, p in ((2 * k, passage), (2 * k + 1, other)):
            table.append((d, " ".join([word() for _ in range(rng.randint(0, 200))] + p + [word() for _ in range(rng.randint(0, 200))])))
    got = {(r["partner_id"], r["doc_id"]) for r in substring_dedup.repeated_passages(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got <= {(d - 1, d) for d in near + exact}
    assert np.mean([(d - 1, d) in got for d in exact]) == 1 and np.mean([(d - 1, d) in got for d in near]) >= 0.9


def test_passage_classes_have_a_row_for_either_side(docs, spark, empty):
    found = [(r["partner_id"], r["doc_id"]) for r in substring_dedup.repeated_passages(docs).collect()]
    top = union(range(200), found)
    linked = {x for e in found for x in e}
    got = {r["doc_id"]: r for r in substring_dedup.document_classes(docs).collect()}
    assert set(got) == linked and {a for a, _ in found} - {b for _, b in found} <= set(got)
    for d, r in got.items():
        assert r["class_id"] == min(x for x in linked if top[x] == top[d])
        assert r["n_links"] == len({e[e[0] == d] for e in set(found) if d in e}) and r["n_passages"] >= 1 and r["longest"] >= 50
    assert substring_dedup.document_classes(empty).count() == 0


def test_passages_overlap_where_no_split_is_left():
    """An edit every thirty shingles: any two neighbouring pieces are a passage, all of them are none, and each single one is too short."""
    a = np.arange(300, dtype=np.uint64)
    b = a.copy()
    for k in range(25, 300, 30):
        b[k : k + 5] += np.uint64(1000)
    got = substring_dedup.align(a, b, [0], 46, 0.8, 10)
    stretches = [i for i in range(255) if (a[i : i + 46] == b[i : i + 46]).sum() >= 41 and a[i] == b[i] and a[i + 45] == b[i + 45]]
    assert stretches and all(any(a0 <= i and i + 46 <= a1 for a0, a1, *_ in got) for i in stretches)
    assert all(s >= 0.8 and (b0, b1) == (a0, a1) for a0, a1, b0, b1, s in got)


def test_places_of_a_common_line_do_not_meet(spark):
    rng = random.Random(31)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, passage = words(12), words(60)
    edited = passage[:50] + words(1) + passage[51:]
    rows = [(k, " ".join(words(60) + line + words(60))) for k in range(40)] + [(40 + k, " ".join(words(20 + k) + p + words(60))) for k, p in enumerate((passage, edited))]
    body = spark.createDataFrame(rows, "doc_id long, text string")
    places = spark.createDataFrame([(0, k, 63) for k in range(40)] + [(1, 40, 45), (1, 41, 46), (2, 40, 2), (2, 41, 2)], "key long, id long, c int")
    bits = common.cut(substring_dedup.bits(places, body, 46), "bits").join(places, ["id", "c"])
    a, b = (bits.select("key", *(F.col(c).alias(f"{k}{c}") for c in bits.columns if c != "key")) for k in "ab")
    got = a.join(b, "key").where("aid < bid").where(substring_dedup.may_share("a", "b", 46, 0.8)).select("key", "aid", "bid").collect()
    assert [tuple(r) for r in got] == [(1, 40, 41)]


def test_pairs_below_the_threshold_are_not_compared(spark, monkeypatch):
    """Sixty sets at similarity 0.6 in one bucket, whose own signatures rule out nothing; two of them are alike."""
    sets = {k: list(range(75)) + list(range(1000 * (k + 1), 1000 * (k + 1) + 25)) for k in range(60)}
    sets[59] = sets[58][:-1] + [7]
    hashed = lambda x: random.Random(x).getrandbits(63)
    every = spark.createDataFrame([(k, [hashed(x) for x in set(v)]) for k, v in sets.items()], "id long, s array<long>")
    counts, cut = [], common.cut

    def counted(df, name):
        out = cut(df, name)
        if name in ("pairs", "met"):
            counts.append(out.count())
        return out

    monkeypatch.setattr(common, "cut", counted)
    near = every.select("id", F.lit(0).alias("sig")), lambda a, b: a == b
    got = common.class_links(every.select(F.lit(1).cast("long").alias("key"), "id"), lambda ids: every.join(ids, "id", "left_semi"), 0.8, near)
    assert [tuple(r) for r in got.collect()] == [(58, 59)] and sum(counts) <= len(sets)


def test_windows_without_a_tree(monkeypatch):
    rng, tree = np.random.default_rng(3), substring_dedup.compact
    monkeypatch.setattr(substring_dedup, "compact", lambda *a: pytest.fail("a text of equal lines makes a tree as deep as it is long"))
    for length, top in ((1, 9), (5, 3), (46, 1 << 31)):
        off = np.r_[0, np.cumsum(rng.integers(0, 130, 9))]
        x = rng.integers(0, top, off[-1]).astype(np.uint64) << np.uint64(32)
        left, c, right = tree(x, off, length)
        want = sorted(zip(np.maximum(left, c - length + 1).tolist(), np.minimum(c, right - length).tolist(), c.tolist()))
        assert list(zip(*(v.tolist() for v in substring_dedup.intervals(x, off, length)))) == want


def test_passages_hash_a_text_once(monkeypatch):
    calls, words = [], kernels.words
    monkeypatch.setattr(kernels, "words", lambda *a: calls.append(1) or words(*a))
    text = [" ".join(f"w{k % m}" for k in range(90)) for m in (1000, 1000, 30)]
    batch = lambda a, b: pa.RecordBatch.from_pydict({"a": [a], "b": [b], "ta": [text[a]], "tb": [text[b]], "shifts": pa.array([[0]], pa.list_(pa.int32()))})
    got = [b.to_pylist() for b in substring_dedup.passages(46, 0.8, 10)(iter([batch(0, 1), batch(0, 2), batch(1, 2)]))]
    assert len(calls) == 3
    assert [(r["a_start"], r["a_end"], r["b_start"], r["b_end"], r["similarity"]) for r in got[0]] == [(0, 90, 0, 90, 1.0)]
    # 30 words in a circle share 26 of the first text's shingles, too few for any passage.
    assert got[1:] == [[], []]


def test_compact_windows_cover_each_subsequence_once():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 62, 60).astype(np.uint64) << np.uint64(1)
    lo, c, hi = substring_dedup.compact(x, np.array([0, 25, 60]), 5)
    for a, b in ((0, 25), (25, 60)):
        for i in range(a, b):
            for j in range(i + 5, b + 1):
                held = [k for k in range(len(c)) if lo[k] <= i <= c[k] < j <= hi[k]]
                assert len(held) == 1 and c[held[0]] == i + int(np.argmin(x[i:j]))


def test_licenses(spark, docs, rows, empty):
    got = license_scan.scan(docs, license_scan.templates(spark)).collect()
    want = set()
    for d, t, *_ in rows:
        w = WORDS.findall((t or "").lower())
        own = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        for k, (_, x) in enumerate(license_scan.TEMPLATES):
            x = WORDS.findall(x.lower())
            x = {tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))}
            if len(own & x) >= 0.8 * len(x):
                want.add((d, k))
    assert want and {(r["doc_id"], r["template_id"]) for r in got} == want
    long = spark.createDataFrame([(1, "Intro words here. " + license_scan.TEMPLATES[1][1].replace("publish, ", "") + " tail of it"), (2, None)], "doc_id long, text string")
    assert [(r["doc_id"], r["template_id"], r["first_word"]) for r in license_scan.scan(long, license_scan.templates(spark)).collect()] == [(1, 1, 3)]
    assert license_scan.scan(empty, license_scan.templates(spark)).count() == 0
    assert license_scan.scan(docs, license_scan.templates(spark).where("false")).count() == 0
    parts = license_scan.scan(docs, license_scan.templates(spark), most=4).collect()
    assert sorted(map(tuple, parts)) == sorted(map(tuple, got))


def test_license_bands_collide_as_promised(spark):
    """Sets of 8 and 12 shingles with 4 in common (J 0.25): 24 independent bands miss one pair in a thousand."""
    n = 3000
    pairs = spark.range(n).select(F.array(*(F.xxhash64("id", F.lit(k)) for k in range(8))).alias("a"), F.array(*(F.xxhash64("id", F.lit(k)) for k in range(4, 16))).alias("b"))
    met = pairs.where(F.arrays_overlap(license_scan.minima(F.col("a"), 24), license_scan.minima(F.col("b"), 24))).count()
    assert met >= 0.997 * n


def test_exact(docs, rows, empty):
    want, first = {}, {}
    norm = {r[0]: SPACES.sub(" ", r[1] or "") for r in rows}
    size = Counter(norm.values())
    for d in sorted(norm):
        first.setdefault(norm[d], d)
    for split in (F.col("doc_id") % 2 == 0, F.lit(True), F.lit(False)):
        got = {r["doc_id"]: r for r in exact_dedup.dedup(docs, split).collect()}
        assert len(got) == len(rows)
        for d, t in norm.items():
            want = (first[t], size[t], first[t] == d, hashlib.sha256(t.encode()).hexdigest())
            assert tuple(got[d])[1:] == want
    assert exact_dedup.dedup(empty, F.lit(True)).count() == 0


def test_fuse_filter():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 1000, 30000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        f = exact_dedup.FuseFilter.build(keys)
        assert f.admits(keys).all()
        other = rng.integers(1 << 63, (1 << 64) - 1, 20000, dtype=np.uint64)
        assert f.admits(other).mean() < 0.01 if n > 7 else True
    assert len(f.table) < 1.25 * n


def cut_bytes(texts, length):
    seen = Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out[d] = (len(t), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0, hashlib.sha256(kept).hexdigest())
    return out


def test_suffixes(docs, rows, empty, spark):
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.cleaned(docs).collect()}
    want = cut_bytes({r[0]: (r[1] or "").encode() for r in rows}, 400)
    assert got == want and sum(w[1] > 0 for w in want.values()) > 5
    rng = random.Random(8)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    small = {i: "".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for i in range(60)} | {60: "a" * 300, 61: "ab" * 100}
    table = spark.createDataFrame(list(small.items()), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.cleaned(table, 24, 7).collect()}
    assert got == cut_bytes({d: t.encode() for d, t in small.items()}, 24)
    assert suffix_dedup.cleaned(empty).count() == 0


def word_stats(text):
    w = WORDS.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_quality(spark, docs, rows, empty):
    got = quality_rules.judge(docs, []).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == word_stats(r["text"])
        assert r["kept"] == (not r["base_failed"])
    rng = random.Random(2)
    junk = [(i, sentence(rng, 80) + (" ###" * 40 if i % 4 == 0 else ""), "en", "s", 1, "n", "k") for i in range(300)]
    table = spark.createDataFrame(junk, KIND)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 300, 1)] + [(None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rules = quality_rules.fit(table, labels)
    assert rules and rules == quality_rules.fit(table.repartition(5), labels)
    kept = quality_rules.filter_quality(table, labels)
    assert kept.columns == table.columns
    got = {r["doc_id"] for r in kept.collect()}
    assert len(got ^ {i for i in range(300) if i % 4}) <= 12
    assert quality_rules.fit(table, labels.where("false")) == []
    assert quality_rules.filter_quality(empty, labels).count() == 0


def test_mixing(spark, docs, rows, empty):
    got = mixing.copies(docs).collect()
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in rows}
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size[r[0]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(total.values()))
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 3 * total[s]}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * total[s]
            left -= target[s]
        open_ -= full
    target |= {s: weight[s] * level for s in open_}
    for r in got:
        assert r["__size"] == size[r["doc_id"]] and r["__source_size"] == total[r["source"]]
        assert r["__target"] == pytest.approx(target[r["source"]])
        rate = target[r["source"]] / total[r["source"]]
        assert r["__copies"] in (math.floor(rate), math.floor(rate) + 1) and r["__copies"] <= 3
    again = {r["doc_id"]: r["__copies"] for r in mixing.copies(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["__copies"] for r in got}
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect()) == Counter({d: c for d, c in again.items() if c})
    assert mixing.mix_sources(empty).count() == 0
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.format_string("s%03d", "id").alias("source"))
    assert {r["__target"] for r in mixing.copies(many).where("doc_id < 3").collect()} == {1500 / (167 + 2 * 167 + 3 * 166) * k for k in (1, 2, 3)}


def bag_of(t):
    w = WORDS.findall(t or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near(docs, rows, empty):
    got = {r["doc_id"]: r for r in bag_minhash.near_duplicates(docs).collect()}
    bags = {r[0]: bag_of(r[1]) for r in rows}
    links = [(a, b) for a in bags for b in bags if a < b and bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values())]
    want = union(bags, links)
    assert {d: r["class_id"] for d, r in got.items()} == want and len(set(want.values())) < len(want)
    assert all(r["kept"] == (r["class_id"] == d) for d, r in got.items())
    assert bag_minhash.keep_one(docs).count() == len(set(want.values()))
    assert bag_minhash.near_duplicates(empty).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    wa, wb = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    row, key = np.r_[np.zeros(60, int), np.ones(60, int)], np.r_[h, h]
    w = np.r_[wa, wb]
    m = 4096
    sig = bag_minhash.signatures(row[w > 0], key[w > 0], w[w > 0], 2, m)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / m)


def test_pieces(docs, rows, empty):
    enc = piece_nbest.encode(docs)
    texts = {r[0]: r[1] or "" for r in rows}
    back = {r["doc_id"]: r["text"] for r in piece_nbest.decode(enc).collect()}
    assert back == texts
    for r in enc.collect():
        assert list(r["scores"]) == sorted(r["scores"], reverse=True) and len({tuple(p) for p in r["pieces"]}) == len(r["pieces"])
    assert all(r["decodes"] for r in piece_nbest.encode_digests(docs).collect())
    assert piece_nbest.encode(empty).count() == 0


def test_n_best_is_exact():
    """All segmentations by the vocabulary alone, in the stated order."""
    import sentencepiece

    held = piece_nbest.pieces()
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_nbest.PIECES)
    ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    low = min(s for s in map(sp.get_score, ids.values()) if s > piece_nbest.UNUSED)

    def every(text):
        whole, out = "▁" + text.replace(" ", "▁"), []

        def walk(at, score, used, sizes):
            if at == len(whole):
                out.append((-score, len(used), [-n for n in sizes], used))
                return
            for end in range(at + 1, len(whole) + 1):
                if whole[at:end] in ids:
                    i = ids[whole[at:end]]
                    walk(end, score + sp.get_score(i), used + [i], sizes + [end - at])
            if whole[at] not in ids:
                raw = [sp.piece_to_id(f"<0x{b:02X}>") for b in whole[at].encode()]
                walk(at + 1, score + (low - 10) * len(raw), used + raw, sizes + [1])

        walk(0, 0.0, [], [])
        return [(-s, used) for s, _, _, used in sorted(out)]

    for text in ("hello", "theory", "ébc\U000130d1x", "x\ny", "aaaaaaaa", "=======", "abababab", "  "):
        assert held.encode(text, 6) == every(text)[:6]
    for text in ("the theory", "a b", "a  b", " a", "a ", "to to to", "a   b c"):
        got, want = held.encode(text, 5), every(text)
        assert [s for s, _ in got] == [s for s, _ in want][:5]
        assert all(x in want for x in got) and len({tuple(p) for _, p in got}) == len(got)
    assert held.encode("", 4)[0][1] == [ids["▁"]]


def test_long_texts_without_blanks_end_soon():
    import time

    held = piece_nbest.pieces()
    began = time.process_time()
    for text in ("a" * 20_000, "=" * 20_000, "ab" * 10_000, "你好世界" * 3_000, "Qx9/" * 4_000):
        got, decodes = held.search(text, 4)
        assert decodes and 1 <= len(got) <= 4 and [s for s, _, _ in got] == sorted((s for s, _, _ in got), reverse=True)
    assert time.process_time() - began < 20


def test_links_connect_all_that_hold(spark):
    """One bucket, twice: stars whose hub is no extreme, bridges between their outer members, and members like no one."""
    rng = random.Random(3)
    hub = list(range(1000, 1100))

    def edited(base, n):
        out = list(base)
        for k in rng.sample(range(len(out)), n):
            out[k] = rng.randrange(10**6, 10**9)
        return out

    sets = {50: hub} | {i: edited(hub, rng.choice([3, 6, 9, 12, 15])) for i in range(50)}
    sets |= {100 + i: edited(sets[rng.randrange(50)], 8) for i in range(40)}
    sets |= {200 + i: [rng.randrange(10**9, 10**12) for _ in range(50)] for i in range(60)}
    table = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    j = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    held = {(a, b) for a in sets for b in sets if a < b and j(sets[a], sets[b]) >= 0.8}
    bucket = spark.createDataFrame([(k, i) for k in (1, 1, 2) for i in sets], "key long, id long")
    links = {(r["a"], r["b"]) for r in common.class_links(bucket, lambda ids: table.join(ids, "id"), 0.8).collect()}
    assert links <= held and union(sets, links) == union(sets, held)
    assert len(set(union(sets, held).values())) > 65


def test_pairs_of_a_bucket_do_not_multiply(spark, monkeypatch):
    """20,000 unlike ids in one bucket: written rows grow with the members, not with their pairs."""
    written = []
    own = common.cut
    monkeypatch.setattr(common, "cut", lambda df, name: written.append((name, out := own(df, name))) or out)
    monkeypatch.setattr(common, "release", lambda *_: None)
    n = 20_000
    bucket = spark.range(n).select(F.lit(1).cast("long").alias("key"), "id")
    near = (spark.range(n).select("id", F.xxhash64("id").alias("sig")), lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= 6)
    sets = lambda ids: ids.select("id", F.array(*(F.col("id") * 4 + k for k in range(4))).alias("s"))
    assert common.class_links(bucket, sets, 0.8, near).count() == 0
    assert max(df.count() for _, df in written) <= n


def test_line_recall(spark):
    """Edited lines of 30 to 900 characters, with and without blanks and beyond Latin, against brute force."""
    rng = random.Random(9)
    scripts = ["abcdefghijklmnopqrstuvwxyz      ", "abcdefghijklmnopqrstuvwxyz", "กขคงจฉชซญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหฬอฮ", "你好世界中文字符測試語言模型數據", "😀😁😂😃😄😅😆😇😈😉😊😋😌😍😎"]
    found: dict[str, list[int]] = {"0.8": [], "0.85": []}
    table, pairs = [], {}
    for i in range(500):
        letters = scripts[i % len(scripts)]
        line = "".join(rng.choice(letters) for _ in range(rng.randint(30, 900))).strip()
        other = list(line)
        for _ in range(max(1, int(len(line) * rng.uniform(0.005, 0.024)))):
            other[rng.randrange(len(other))] = rng.choice(letters)
        other = "".join(other).strip()
        table += [(2 * i, line), (2 * i + 1, other)]
        pairs[2 * i + 1] = jaccard5(line, other)
    got = {r["doc_id"]: r["keep_doc_id"] for r in line_dedup.line_classes(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    for d, s in pairs.items():
        assert got[d - 1] == d - 1 and got[d] in (d, d - 1) and (s >= 0.8 or got[d] == d)
        if s >= 0.8:
            found["0.85" if s >= 0.85 else "0.8"].append(got[d] == d - 1)
    assert all(len(x) > 50 for x in found.values())
    assert np.mean(found["0.8"]) >= 0.9 and np.mean(found["0.85"]) >= 0.97
    ends = spark.createDataFrame([(1, "x" + "".join(rng.choice(scripts[1]) for _ in range(600)))], "doc_id long, text string")
    ends = ends.union(ends.select(F.lit(2).cast("long"), F.concat(F.lit("y"), F.expr("substring(text, 2)"))))
    assert {r["keep_doc_id"] for r in line_dedup.line_classes(ends).collect()} == {1}


def test_passage_of_one_repeated_line(spark):
    """Twelve words five times over have twelve distinct shingles, in a passage of sixty words."""
    rng = random.Random(11)
    line = sentence(rng, 12)
    body = "\n".join([line] * 5)
    table = spark.createDataFrame([(1, sentence(rng, 30) + "\n" + body + "\n" + sentence(rng, 30)), (2, sentence(rng, 45) + "\n" + body), (3, sentence(rng, 90))], "doc_id long, text string")
    got = [(r["doc_id"], r["start_word"], r["end_word"], r["partner_id"], r["partner_start"], r["partner_end"], r["similarity"]) for r in substring_dedup.repeated_passages(table).collect()]
    assert got == [(2, 45, 105, 1, 30, 90, 1.0)]


def test_lines_of_few_shingles_meet_at_any_length(spark):
    """Equal sets of shingles in lines of 5 to 600 characters, whatever their lengths."""
    rng = random.Random(12)
    phrase = sentence(rng, 3)
    groups = [["-" * n for n in (5, 6, 7, 80, 110, 130, 600)], [" ".join([phrase] * n) for n in (3, 5, 11, 30)]]
    table = spark.createDataFrame([(100 * g + i, x) for g, group in enumerate(groups) for i, x in enumerate(group)], "doc_id long, text string")
    got = {r["doc_id"]: r["keep_doc_id"] for r in line_dedup.line_classes(table).collect()}
    assert got == {100 * g + i: 100 * g for g, group in enumerate(groups) for i in range(len(group))}


def test_links_are_contracted_once(spark, monkeypatch):
    """Turns after the first contract only what their own links connect, stars need no round, and no pairs come out that signatures tell apart."""
    rng = random.Random(5)
    written = []
    own = common.cut
    monkeypatch.setattr(common, "cut", lambda df, name: written.append((name, out := own(df, name))) or out)
    monkeypatch.setattr(common, "release", lambda *_: None)
    sets = {}
    for g in range(40):
        base = [rng.randrange(-(2**63), 2**63) for _ in range(100)]
        for k in range(6):
            sets[100 * g + k] = base[:96] + [rng.randrange(2**60) for _ in range(4)]
    found = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    # Pairs of groups share a bucket, and one bucket holds all.
    buckets = spark.createDataFrame([(i // 200, i) for i in sets] + [(-1, i) for i in sets], "key long, id long")
    roots = {r["node"]: r["root"] for r in common.class_roots(buckets, lambda ids: found.join(ids, "id", "left_semi"), 0.8).collect()}
    assert roots == {i: i - i % 100 for i in sets if i % 100}
    assert sum(df.count() for name, df in written if name == "edges") <= 3 * len(sets)
    assert max(df.count() for name, df in written if name in ("pairs", "met")) <= 4 * len(sets)


def test_odd_bits_keep_all_alike(spark):
    """No pair of similarity 0.8 is told apart by its signatures, whatever its size; unlike ones are."""
    rng = random.Random(6)
    sets = {}
    for i, n in enumerate([1, 2, 5, 9, 30, 120, 600, 2000] * 4):
        base = [rng.randrange(-(2**63), 2**63) for _ in range(n)]
        sets[3 * i], sets[3 * i + 1] = base, base[n // 10 :] + [rng.randrange(2**62) for _ in range(n // 12)]
        sets[3 * i + 2] = [rng.randrange(2**62) for _ in range(n)]
    elements = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "id long, x long")
    sig, may = common.odd_bits(elements, 0.8)
    a, b = (sig.select(F.col("id").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "ab")
    near = {(r["a"], r["b"]) for r in a.crossJoin(b).where("a < b").where(may(F.col("sig_a"), F.col("sig_b"))).collect()}
    j = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    alike = {(a, b) for a in sets for b in sets if a < b and j(sets[a], sets[b]) >= 0.8}
    assert len(alike) >= 25 and alike <= near
    assert not {(a, b) for a, b in near - alike if len(sets[a]) >= 30}


def test_pieces_of_a_batch_are_decoded_at_once(monkeypatch):
    """Chunks with line feeds, blanks, marks, bytes and ties give what single searches give; a batch needs no check per chunk."""
    texts = ["", " ", "a", "a ", " a", "a\nb", "a\n b", "\n", "\n\na", "a \n", "a  b\n\n c", "▁x y", "plain words without more", "\x00 \U0001f9ea zz\n", "ab " * 50, "é ü\tß\r\n x"]
    texts += [f"word{i} and w{i}x{i} or {i * 7919}" for i in range(200)]
    calls = []
    own = piece_nbest.Pieces.join
    monkeypatch.setattr(piece_nbest.Pieces, "join", lambda self, p: calls.append(1) or own(self, p))
    held = piece_nbest.Pieces(piece_nbest.PIECES)
    parts = held.learn(texts)
    assert len(calls) < len(held.new) / 4
    alone = piece_nbest.Pieces(piece_nbest.PIECES)
    for text, chunks in zip(texts, parts):
        spaced = piece_nbest.CHUNK.findall(piece_nbest.MARK + text.replace(" ", piece_nbest.MARK))
        split = [y for x in spaced for y in (re.split("(\n)", x) if alone.lone else [x]) if y]
        assert chunks == split
        for chunk in chunks:
            one, two = held.new[chunk], alone.first(chunk)
            assert (one[1], one[3]) == (two[1], two[3]) and (one[2] == two[2] or abs(one[2] - two[2]) < 1e-6)
        assert held.search(text, 4, chunks)[1] == alone.search(text, 4)[1]
        assert [p for _, _, p in held.search(text, 4, chunks)[0]] == [p for _, _, p in alone.search(text, 4)[0]]
