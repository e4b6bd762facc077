"""Steps that several queries share: exact quantiles, and windows that are made once."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse import catalog
from gridpulse.functions import signal as S
from gridpulse.operators import correlate, events, reports, temporal, windows

DATA = "/root/testdata/sf0.001"


def text(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_quantiles_are_exact(spark):
    """More values than a sketch keeps, some very frequent; nulls are left out, and a column may have no value."""
    rng = random.Random(1)
    rows = [(float(rng.choice([rng.gauss(0, 1), 0.25])), float(rng.randrange(3)) if i % 5 else None, None) for i in range(60_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    shares = [(k, 100) for k in range(1, 100)] + [(9, 10)]
    got = reports.quantiles(df, ("a", "b", "c"), shares)
    for k, c in enumerate("ab"):
        x = sorted(r[k] for r in rows if r[k] is not None)
        assert got[c] == [x[-(-p * len(x) // q) - 1] for p, q in shares]
    assert got["c"] == [None] * 100 and math.isfinite(got["a"][0])


@pytest.mark.parametrize("name", ["event_profile", "anomalous_windows", "severity_by_axes", "type_labels"])
def test_windows_are_made_once(name, spark):
    """Neither a filter nor a second branch brings the samples, or the padding of windows, into the plan again."""
    plan = text(catalog.queries()[name](spark, DATA))
    assert "events.parquet" not in plan and "array_repeat" not in plan


def test_pairs_of_windows_of_many_lengths():
    """Blocks against one pair at a time: copies, constant, empty and missing windows, lengths on both sides of ``DIRECT``."""
    rng = np.random.default_rng(2)
    make = lambda k: [rng.normal(size=rng.choice([1, 2, 7, 8, 40, S.DIRECT + 4])) for _ in range(k)]
    xs, ys = make(25) + [np.zeros(0), None, np.ones(8)], make(20) + [None, np.full(40, 3.0)]
    ys += [xs[0].copy(), xs[0].copy(), 2 * xs[1] + 1]
    forward = rng.random((len(xs), len(ys))) < 0.5
    cut = lambda x, y: (np.asarray(x[: min(len(x), len(y))])[None], np.asarray(y[: min(len(x), len(y))])[None]) if x is not None and y is not None else (np.zeros((1, 0)),) * 2
    bounded, full = np.zeros(forward.shape), np.full(forward.shape, -1.0)
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            a, b = cut(x, y)
            bounded[i, j] = (S.ncc_bounded(a, b, 30) if forward[i, j] else S.ncc_bounded(b, a, 30))[0]
            full[i, j] = S.ncc_full(a, b)[0] if a.shape[1] else -1
    assert S.bounded_pairs(xs, ys, forward, ~forward, 30) == pytest.approx(bounded, abs=1e-9)
    for least in (0.0, 0.05, 0.6, 0.95):
        i, j, r = S.full_pairs(xs, ys, least)
        assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(full >= least))) and r == pytest.approx(full[i, j], abs=1e-9)
    i, j, r = S.nearest_pairs(xs, ys)
    best = {k: max(((round(v, 9), -n) for v, n in zip(r[i == k], j[i == k]))) for k in set(i)}
    assert best == {k: max((round(v, 9), -n) for n, v in enumerate(row)) for k, row in enumerate(full) if row.max() >= 0}


def test_windows_travel_in_blocks(spark):
    """``type_pairs`` gives no pair of windows to a function of its own."""
    plan = text(catalog.type_pairs(spark, DATA))
    assert "EvalPython" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("step", [3, 50, 1_000_000])
def test_near_events_do_not_depend_on_pieces(step):
    """Two sides and one, one frequent signal, equal times and ids, against all pairs one by one."""
    rng = np.random.default_rng(4)
    n = 160
    us, sig, cid, ev = rng.integers(0, 300, n), np.where(rng.random(n) < 0.4, 2, rng.integers(0, 7, n)), rng.integers(0, 3, n), rng.integers(0, 60, n)
    for side in (None, sig % 2 == 1):
        want = {}
        for a in range(n):
            for b in range(n):
                met = sig[a] != sig[b] if side is None else side[a] != side[b]
                if met and (cid[a], ev[a], sig[a]) < (cid[b], ev[b], sig[b]) and abs(us[a] - us[b]) <= 20:
                    want.setdefault((cid[a], cid[b]), []).append((abs(us[a] - us[b]), sig[a], sig[b]))
        got = temporal.count_near(us, sig, cid, ev, side, 20, step)
        assert got == {k: [len(v), len({x[1:] for x in v}), sum(x[0] for x in v), min(x[0] for x in v)] for k, v in want.items()}


def test_pairs_of_events_are_not_shuffled(spark):
    plan = text(catalog.cooccurrence(spark, DATA))
    assert "Join" not in plan


def test_linkage_holds_one_condensed_array():
    """The same clusters as from the matrix, in a quarter of what the matrix, its clipped copy and the array took."""
    import tracemalloc

    x = np.random.default_rng(8).normal(size=(400, 32))
    x[50:60] = x[40:50]
    want = S.average_linkage(np.clip(1 - S.bounded_matrix(x), 0, 1), 0.6)
    tracemalloc.start()
    got = S.average_linkage(S.condensed_distances(x), 0.6)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == want.tolist() and len(set(got)) < 400 and most < 20 * 400**2 / 2
    assert S.average_linkage(S.condensed_distances(x[:1]), 0.6).tolist() == [0]


def test_signals_are_clustered_in_batches(spark):
    """Many signals of few events, over the ends of batches, cost no call each; a signal's types are those it has alone."""
    rng = np.random.default_rng(4)
    few = [(f"s{k}", e, rng.normal(size=8).tolist()) for k in range(40) for e in range(int(rng.integers(1, 5)))]
    rows = few + [("many", e, [float(np.sin((e % 3 + 1) * i)) for i in range(8)]) for e in range(30)] + [(None, 0, [1.0] * 8)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "sig_key string, event_idx long, signal array<double>")
    got = events.cluster_types(df, 0.7)
    assert "FlatMapGroupsInPandas" not in text(got)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.sig_key, r.event_idx): r.type_id for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == key)
        types = S.average_linkage(S.condensed_distances(np.array([s for _, s in own])), 0.3)
        want |= {(key, e): t for (e, _), t in zip(own, types.tolist())}
    assert got == want and len({t for (k, _), t in got.items() if k == "many"}) == 3


def test_samples_are_shuffled_once(spark):
    """Windows are told from pieces of samples that are written once; runs that pass several stretches are put together in order."""
    assert "events.parquet" not in text(catalog.gap_windows(spark, DATA))
    rows = [("a", 50 * i + (i >= 300) * 1000, i) for i in range(600)]
    df = spark.createDataFrame(rows[::-1], "sig_key string, s long, tie long").selectExpr("sig_key", "timestamp_seconds(s)::timestamp_ntz AS ts", "tie", "tie::double AS signal")
    got = windows.gap_windows(df, 60, 1, split_by_date=False).orderBy("win_idx").collect()
    assert [r.signal for r in got] == [[float(i) for i in range(300)], [float(i) for i in range(300, 600)]]
    assert [r.seconds for r in got] == [[50.0 * i for i in range(300)]] * 2


def test_chain_of_regular_windows_alone(spark):
    """Windows that are not regular may be left out: the next one begins an event."""
    rows = [("a", i, i not in (2, 5), [1.0, 3.0, 2.0, 0.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "sig_key string, win_idx long, regular boolean, signal array<double>")
    pick = lambda w, dense: sorted((r.win_idx, r.event_idx) for r in events.chain(w, 0.9, dense=dense).collect())
    assert pick(df.where("regular"), True) == pick(df, False) == [(0, 0), (1, 0), (3, 1), (4, 1), (6, 2), (7, 2), (8, 2)]


@pytest.mark.parametrize("block", [8, 2048])
def test_types_that_are_shared_without_their_pairs(spark, monkeypatch, block):
    """Those of all pairs, whether they meet in a block of their own or across; most are alike, some like one other, some like none."""
    monkeypatch.setattr(events, "BLOCK", block)
    rng = np.random.default_rng(6)
    base, odd = rng.normal(size=12), rng.normal(size=(6, 30))
    rows = [(f"s{k % 7}", k, (base + rng.normal(size=12) * 0.1).tolist()) for k in range(40)]
    rows += [(f"s{k}", 100 + k, odd[k % 3].tolist()) for k in range(6)] + [("s0", 200 + k, odd[3].tolist()) for k in range(2)] + [("s1", 300, [1.0] * 9)]
    df = spark.createDataFrame(rows, "sig_key string, cid long, window array<double>")
    pairs = events.shared_types(df, 0.8).collect()
    want = {(r[f"sig_key_{k}"], r[f"cid_{k}"]) for r in pairs for k in "ab"}
    got = [(r.sig_key, r.cid) for r in events.sharing(df, 0.8).collect()]
    assert sorted(got) == sorted(want) and 46 <= len(want) < len(rows)


def test_windows_travel_as_often_however_many_there_are(spark):
    few, many = (spark.range(n).selectExpr("id", "array(1d, 2d) AS window") for n in (40, 100_000))
    assert events.blocks(few) == 1 and events.blocks(many) == events.PARTS
    # Unless a block would be too large to hold.
    assert events.blocks(many.selectExpr("id", "transform(sequence(1, 3000), x -> double(x)) AS window")) == -(-100_000 * 3000 * 8 // events.BLOCK_BYTES)


def test_pairs_do_not_depend_on_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    w = rng.normal(size=(90, 10)).cumsum(1).round(2)
    w[40:44] = w[3]
    df = spark.createDataFrame([(f"s{k % 3}", k, v.tolist()) for k, v in enumerate(w)], "sig_key string, cid long, window array<double>")
    known = df.withColumnRenamed("cid", "type_id")
    seen = []
    for parts, block in ((16, 2048), (2, 7)):
        monkeypatch.setattr(events, "PARTS", parts)
        monkeypatch.setattr(events, "BLOCK", block)
        pairs = sorted((*r[:4], round(r.ncc, 9)) for r in events.shared_types(df, 0.7).collect())
        best = sorted((r.id, r.type_id, round(r.ncc, 9)) for r in events.nearest_type(df.withColumnRenamed("cid", "id"), known, 0.0, "sig_key").collect())
        seen.append((pairs, best))
    assert seen[0] == seen[1] and len(seen[0][0]) > 90 and len(seen[0][1]) == 90


def test_distances_of_short_windows_are_multiplied_out(monkeypatch):
    """The same distances as from spectra; those to equal windows stay equal."""
    x = np.random.default_rng(9).normal(size=(300, 31))
    x[200:220], x[250] = x[:20], 1.0
    want = np.clip(1 - S.bounded_matrix(x), 0, 1)[np.triu_indices(300, 1)]
    monkeypatch.setattr(S.Spectra, "best", lambda *a: pytest.fail("pairs are turned back one by one"))
    got = S.condensed_distances(x)
    assert np.abs(got - want).max() < 2e-12
    full = np.zeros((300, 300))
    full[np.triu_indices(300, 1)] = got
    # Rows after both copies, which are second in either pair.
    assert (full[:20, 220:] == full[200:220, 220:]).all()


def test_rollup_does_not_cluster(spark):
    """No column of its result, nor its SQL, tells types."""
    assert "MapInArrow" in text(catalog.type_linkage(spark, DATA)) and "MapInArrow" not in text(catalog.profile_rollup(spark, DATA))


def test_lists_of_all_pairs_are_rounded_without_decimals(spark):
    assert "round(" not in text(catalog.type_pairs(spark, DATA)) and "round(" not in text(catalog.shared_types(spark, DATA))
    rows = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9).alias("x"))
    assert rows.where(catalog.five("x") != F.round("x", 5)).count() == 0


def test_pairs_of_types_are_shuffled_once(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(f"s{k % 4}", k // 4, k, float(k), rng.normal(size=6).tolist()) for k in range(40)]
    df = spark.createDataFrame(rows, "sig_key string, cid int, count long, mean_freq double, window array<double>")
    few = correlate.shared(df, 0.7)
    assert "hashpartitioning(sig_key_" not in text(few)
    monkeypatch.setattr(correlate, "FEW_TYPES", 3)
    pick = lambda d: [(r.pair_idx, r.sig_key_a, r.cid_a, r.count_a, r.sig_key_b, r.cid_b, r.count_b, r.mean_freq_b) for r in d.orderBy("pair_idx").collect()]
    got = pick(few)
    assert got == pick(correlate.shared(df, 0.7)) and [r[0] for r in got] == list(range(len(got))) and len(got) > 20
    assert all(a == f"s{n % 4}" and b == f"s{m % 4}" and m == f for _, a, _, n, b, _, m, f in got)
