"""Kernels with answers worked out by hand."""

import time

import numpy as np
import pytest

from gridpulse.functions import signal as S
from gridpulse.operators import windows
from gridpulse.sources import registry


def test_correlation():
    x, y = np.zeros((1, 8)), np.zeros((1, 8))
    x[0, 1] = y[0, 5] = 1
    assert S.ncc_bounded(x, y)[0] == pytest.approx(0.9286, abs=1e-4) and S.ncc_bounded(y, x)[0] == pytest.approx(0.1964, abs=1e-4)
    r = np.random.default_rng(0).normal(size=(3, 31))
    assert S.ncc_bounded(r, r) == pytest.approx(1) and S.ncc_full(r, -r) == pytest.approx(1)
    assert S.ncc_full(r[:1], np.ones((1, 31)))[0] == 0 and S.ncc_full(r[:1], r[1:2]) == pytest.approx(S.ncc_full(r[1:2], r[:1]))


def test_spectrum_and_low_pass():
    t = np.arange(5001)[None] * 0.0002
    a = S.amplitudes(np.cos(2 * np.pi * 50 * t), t)
    assert S.FREQUENCIES[a.argmax()] == 50 and a.max() == pytest.approx(1.0004, abs=1e-4)
    t = np.arange(1000)[None] / 1000
    low, high = np.sin(2 * np.pi * 50 * t), np.sin(2 * np.pi * 400 * t)
    # The step comes from the duration over L - 1, so bins fall a thousandth apart.
    assert np.abs(S.low_pass(low + high, t, 100.0) - low).max() < 1e-6
    assert not S.amplitudes(np.ones((1, 4)), np.zeros((1, 4))).any()


def test_peaks_and_linkage():
    assert S.two_means_peaks(np.array([1, 1, 1, 10, 10, 1, 10.0])) == 2 and S.two_means_peaks(np.ones(9)) == 0
    d = np.array([[0, 0.1, 0.35], [0.1, 0, 0.15], [0.35, 0.15, 0]])
    assert S.average_linkage(d, 0.2).tolist() == [0, 0, 1]
    assert S.average_linkage(np.zeros((0, 0)), 0.2).tolist() == [] and S.average_linkage(np.zeros((1, 1)), 0.2).tolist() == [0]


def test_registry():
    a, b = [0.0, 1, 0, 2, 0, 3, 1, 0], [5.0, 1, 4, 1, 9, 2, 6, 5]
    ids, new = registry.fold([("x", a, None), ("y", [-v for v in a], None), ("z", b, None)], [], -1, 0.95)
    assert ids == {"x": 0, "y": 0, "z": 1} and [t for t, _ in new] == [0, 1]
    # A type known before wins a tie over one that came since; equal similarities go to the lower id.
    assert registry.fold([("x", a, (1.0, 7))], [(9, a)], 9, 0.95)[0] == {"x": 7}
    assert registry.fold([("x", a, None)], [(3, a), (5, a)], 5, 0.95)[0] == {"x": 3}


def test_linkage_is_the_plain_one():
    """Merging the closest pair of the whole matrix each time, with ties in it."""

    def plain(d, cut):
        d, n = d.copy(), len(d)
        np.fill_diagonal(d, np.inf)
        label, size = np.arange(n), np.ones(n)
        while n > 1:
            i, j = sorted(divmod(int(d.argmin()), n))
            if not d[i, j] <= cut:
                break
            d[i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
            d[:, i] = d[i]
            d[i, i] = d[j] = d[:, j] = np.inf
            size[i] += size[j]
            label[label == j] = i
        seen = {}
        return [seen.setdefault(int(x), len(seen)) for x in label]

    rng = np.random.default_rng(4)
    for k in range(120):
        n = int(rng.integers(0, 25))
        d = rng.random((n, n))
        d = d + d.T
        d = np.round(d * 3) / 3 if k % 2 else d
        cut = float(rng.random() * 2)
        assert S.average_linkage(d, cut).tolist() == plain(d, cut)


def test_linkage_of_ten_thousand():
    rng = np.random.default_rng(5)
    x = np.sort(rng.random(10_000)).astype("float32")
    began = time.time()
    labels = S.average_linkage(np.abs(x[:, None] - x[None, :]), 0.001)
    assert time.time() - began < 60 and labels.max() > 300 and (np.diff(labels) >= 0).all()


def test_blocks_of_pairs_are_all_pairs():
    """Windows of several lengths, empty and constant ones: pairs by bound and by blocks as one by one."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=40)
    xs = [rng.normal(size=n) if k % 3 else np.roll(base[:n], k) + rng.normal(0, 0.2, n) for k, n in enumerate([16, 16, 40, 33, 0, 16, 40, 1])] + [np.ones(16), None]
    for least in (0.0, 0.5):
        i, j, r = S.full_pairs(xs, xs, least)
        got = {(a, b): c for a, b, c in zip(i, j, r)}
        want = {}
        for a, x in enumerate(xs):
            for b, y in enumerate(xs):
                n = min(len(x) if x is not None else 0, len(y) if y is not None else 0)
                if n:
                    want[a, b] = S.ncc_full(np.array([x[:n]]), np.array([y[:n]]))[0]
        assert got == pytest.approx({k: v for k, v in want.items() if v >= least}, abs=1e-9)
    x = rng.normal(size=(7, 12))
    m = S.bounded_matrix(x, 4)
    assert m == pytest.approx(np.array([[0 if a == b else S.ncc_bounded(x[[min(a, b)]], x[[max(a, b)]], 4)[0] for b in range(7)] for a in range(7)]), abs=1e-9)


def test_windows(spark):
    rows = [("s", 0.0, 1), ("s", 0.5, 2), ("s", 1.0, 3), ("s", 1.6, 4)]
    df = spark.createDataFrame(rows, "sig_key string, t double, tie long").selectExpr("sig_key", "cast(timestamp_micros(cast(t * 1000000 as bigint)) as timestamp_ntz) ts", "tie", "cast(tie as double) signal")
    w = windows.gap_windows(df, 0.5, 1).orderBy("win_idx").collect()
    assert [(r["win_idx"], r["n"]) for r in w] == [(0, 3), (1, 1)] and w[0]["seconds"] == [0, 0.5, 1]
    two = spark.createDataFrame([("s", 0, [1.0, 3.0], [0.0, 1.0]), ("s", 1, [0.0, 0.0, 6.0], [0.0, 1.0, 2.0])], "sig_key string, win_idx long, signal array<double>, seconds array<double>")
    got = windows.centre_pad(two).orderBy("win_idx").collect()
    assert [r["signal"] for r in got] == [[-1, 1, 0], [-2, -2, 4]] and got[0]["seconds"] == [0, 1, 2]
    spike = spark.createDataFrame([([0.0, 0.0, 9.0, 0.0, 0.0],), ([],)], "signal array<double>")
    assert [r["energy"] for r in windows.energy(spike).collect()] == [0, 0]
    flat = spark.createDataFrame([([0.0, 55.0] * 10,), ([30.0, -29.0],)], "signal array<double>")
    assert [r["is_anomaly"] for r in windows.segment_range(flat.limit(1), 10, 55).collect()] == [False]
    assert [r["has_peak"] for r in windows.two_sided(flat, 30).collect()] == [False, False]
