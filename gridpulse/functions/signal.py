"""Vectorised signal kernels on (B, L) arrays, and pandas UDFs over array columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

#: The spectral grid in Hz.
FREQUENCIES = np.arange(10.0, 2510.0, 10.0)
BATCH = 64


def by_length(values: pd.Series, *more: pd.Series):
    """Index and stacked rows of arrays of one length."""
    sizes = values.map(len).to_numpy()
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, *(np.stack([np.asarray(s.iloc[i], float) for i in at]) if n else np.zeros((len(at), 0)) for s in (values, *more))


def amplitudes(x: np.ndarray, t: np.ndarray, freqs: np.ndarray = FREQUENCIES) -> np.ndarray:
    """Direct Fourier amplitudes at actual times; zero where there is no duration."""
    n = x.shape[1]
    out = np.zeros((len(x), len(freqs)))
    for lo in range(0, len(x), BATCH):
        rel = t[lo : lo + BATCH] - t[lo : lo + BATCH, :1]
        phase = 2 * np.pi * rel[:, None, :] * freqs[None, :, None]
        b = x[lo : lo + BATCH, None, :]
        out[lo : lo + BATCH] = 2 / max(n - 1, 1) * np.hypot((b * np.cos(phase)).sum(2), (b * np.sin(phase)).sum(2))
    return np.where((t[:, -1:] > t[:, :1]) if n else False, out, 0.0)


def low_pass(x: np.ndarray, t: np.ndarray, cutoff: float) -> np.ndarray:
    """Zero all bins above the cutoff; windows without duration stay as they are."""
    n = x.shape[1]
    if n < 2:
        return x
    dt = (t[:, -1] - t[:, 0]) / (n - 1)
    ok = dt > 0
    f = np.arange(n // 2 + 1)[None, :] / (n * np.where(ok, dt, 1.0)[:, None])
    y = np.fft.irfft(np.where(f <= cutoff, np.fft.rfft(x, axis=1), 0), n=n, axis=1)
    return np.where(ok[:, None], y, x)


def correlate(x: np.ndarray, y: np.ndarray, full: bool) -> tuple[np.ndarray, np.ndarray]:
    """Absolute normalised cross-correlation at all lags, and the lags; sum of x[n + lag] * y[n]."""
    n = x.shape[1]
    xc, yc = x - x.mean(1, keepdims=True), y - y.mean(1, keepdims=True)
    size = 1 << max(1, (2 * n - 1).bit_length())
    c = np.fft.irfft(np.fft.rfft(xc, size) * np.conj(np.fft.rfft(yc, size)), size)
    lags = np.arange(-(n - 1), n) if full else np.arange(-(n // 2), (n - 1) // 2 + 1)
    scale = n * xc.std(1) * yc.std(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.abs(c[:, lags]) / (scale[:, None] if full else scale[:, None] + 1e-12)
    return np.where((scale > 0)[:, None], r, 0.0), lags


def ncc_bounded(x: np.ndarray, y: np.ndarray, max_lag: int = 5000) -> np.ndarray:
    """Largest value within the lag limit; lags also stay within half a window, so order matters for even lengths."""
    if not x.shape[1]:
        return np.zeros(len(x))
    r, lags = correlate(x, y, False)
    return r[:, np.abs(lags) <= max_lag].max(1)


def ncc_full(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Largest value over all lags."""
    return correlate(x, y, True)[0].max(1) if x.shape[1] else np.zeros(len(x))


def two_means_peaks(x: np.ndarray, width: int = 1, ratio: float = 400.0) -> int:
    """Isolated peaks of one window: exact one-dimensional 2-means of segment scores max(x**4)."""
    n = len(x) // width
    if n < 2:
        return 0
    score = (np.asarray(x[: n * width], float).reshape(n, width) ** 4).max(1)
    s = np.sort(score)
    if s[0] == s[-1]:
        return 0
    sums, squares, k = np.cumsum(s), np.cumsum(s * s), np.arange(1, n)
    left = squares[:-1] - sums[:-1] ** 2 / k
    right = (squares[-1] - squares[:-1]) - (sums[-1] - sums[:-1]) ** 2 / (n - k)
    cut = int(np.argmin(np.where(s[1:] > s[:-1], left + right, np.inf))) + 1
    low, high = s[:cut].mean(), s[cut:].mean()
    if high / max(low, 1e-9) < ratio:
        return 0
    hit = np.flatnonzero(score >= high)
    return 1 + int((np.diff(hit) > 1).sum()) if len(hit) else 0


#: Products of spectra are turned back in pieces of about so many numbers.
PIECE = 1 << 21


class Spectra:
    """Spectra of centred windows of one length, taken once for all pairs they are in."""

    def __init__(self, x: np.ndarray) -> None:
        self.n = n = x.shape[1]
        self.size = 1 << max(1, (2 * n - 1).bit_length())
        self.f = np.fft.rfft(x - x.mean(1, keepdims=True), self.size)
        self.sd = x.std(1)

    def best(self, other: Spectra, i: np.ndarray, j: np.ndarray, lags: np.ndarray | None = None, eps: float = 0.0) -> np.ndarray:
        """Largest absolute normalised correlation of own rows ``i`` with rows ``j`` of ``other``, over ``lags`` or all; 0 where a window is constant."""
        out = np.zeros(len(i))
        step = max(1, PIECE // self.size)
        for lo in range(0, len(i), step):
            c = np.abs(np.fft.irfft(self.f[i[lo : lo + step]] * np.conj(other.f[j[lo : lo + step]]), self.size))
            out[lo : lo + step] = (c if lags is None else c[:, lags]).max(1)
        scale = self.n * self.sd[i] * other.sd[j]
        return np.where(scale > 0, out / np.where(scale > 0, scale + eps, 1.0), 0.0)

    def bound(self, other: Spectra) -> np.ndarray:
        """For all pairs a value that their correlation cannot pass at any lag: the sum of products of magnitudes."""
        weight = np.full(self.f.shape[1], 2.0)
        weight[[0, -1]] = 1.0
        scale = self.n * self.sd[:, None] * other.sd[None, :]
        top = (np.abs(self.f) * weight) @ np.abs(other.f).T / self.size
        return np.where(scale > 0, top / np.where(scale > 0, scale, 1.0), 0.0)


#: Up to this many samples all lags of a block of windows are multiplied out; beyond, pairs are turned back from their spectra.
DIRECT = 256
#: Rows of a side that are multiplied at once, so that a block of products stays near the processor.
TILE = 256
#: Rows whose distances to all later ones are held beside the array they go to.
ROWS = 64


def unit(x: np.ndarray) -> np.ndarray:
    """Centred rows of length one; zeros for constant ones."""
    c = x - x.mean(1, keepdims=True)
    norm = x.std(1, keepdims=True) * np.sqrt(x.shape[1])
    return np.where(norm > 0, c / np.where(norm > 0, norm, 1.0), 0.0)


def lag_products(x: np.ndarray, y: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """Greatest absolute sum of x[n + lag] * y[n] over ``lags`` for all pairs of rows."""
    n, out = x.shape[1], np.zeros((len(x), len(y)), x.dtype)
    for lo in range(0, len(x), TILE):
        for at in range(0, len(y), TILE):
            p, q, best = x[lo : lo + TILE], y[at : at + TILE], out[lo : lo + TILE, at : at + TILE]
            c, most = np.empty(best.shape, x.dtype), np.zeros(best.shape, x.dtype)
            for k in lags:
                np.matmul(p[:, max(k, 0) : n + min(k, 0)], q[:, max(-k, 0) : n - max(k, 0)].T, out=c)
                np.maximum(most, np.abs(c, out=c), out=most)
            best[:] = most
    return out


def heads(xs: list, ys: list):
    """Rows of both sides that are cut to one length, the shorter of the two: ``at_x, at_y`` and the rows."""
    nx, ny = (np.array([0 if v is None else len(v) for v in s], int) for s in (xs, ys))
    # One matrix for each side, filled once; zeros after the end of a row are never looked at.
    whole = [np.zeros((len(s), int(n.max(initial=0)))) for s, n in ((xs, nx), (ys, ny))]
    for m, s in zip(whole, (xs, ys)):
        for k, v in enumerate(s):
            if v is not None:
                m[k, : len(v)] = v
    for n in np.union1d(nx, ny):
        for at_x, at_y in ((np.flatnonzero(nx == n), np.flatnonzero(ny >= n)), (np.flatnonzero(nx > n), np.flatnonzero(ny == n))):
            if n and len(at_x) and len(at_y):
                yield at_x, at_y, whole[0][at_x, :n], whole[1][at_y, :n]


def rough(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Full-range similarity of all pairs in single precision, and by how much it may be off."""
    n = x.shape[1]
    return lag_products(unit(x).astype("f4"), unit(y).astype("f4"), np.arange(1 - n, n)), (n + 8) * 1.2e-7


def joined(found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def full_pairs(xs: list, ys: list, least: float = 0.0, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of ``xs``, row of ``ys``, full-range similarity) of at least ``least``; empty windows are in none.

    Pairs that stay below ``least`` by a bound or in single precision (or that are not ``allowed``) are not looked at again.
    """
    found = []
    for at_x, at_y, x, y in heads(xs, ys):
        may, n = np.ones((len(at_x), len(at_y)), bool) if allowed is None else allowed[np.ix_(at_x, at_y)], x.shape[1]
        if least > 0 and n <= DIRECT:
            near, off = rough(x, y)
            may = may & (near >= least - off - 1e-9)
        elif least > 0:
            may = may & (Spectra(x).bound(Spectra(y)) >= least - 1e-9)
        i, j = np.nonzero(may)
        if n <= DIRECT and 5 * len(i) > may.size:
            r = lag_products(unit(x), unit(y), np.arange(1 - n, n))[i, j]
        else:
            r = Spectra(x).best(Spectra(y), i, j)
        found.append((at_x[i[r >= least]], at_y[j[r >= least]], r[r >= least]))
    return joined(found)


def nearest_pairs(xs: list, ys: list, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``full_pairs``, but of each row of ``xs`` only pairs that may be its best."""
    found = []
    for at_x, at_y, x, y in heads(xs, ys):
        may, n = np.ones((len(at_x), len(at_y)), bool) if allowed is None else allowed[np.ix_(at_x, at_y)], x.shape[1]
        if n <= DIRECT:
            near, off = rough(x, y)
            near = np.where(may, near, -1.0)
            may = may & (near >= near.max(1, keepdims=True) - 2 * off)
        i, j = np.nonzero(may)
        found.append((at_x[i], at_y[j], Spectra(x).best(Spectra(y), i, j)))
    return joined(found)


def bounded_pairs(xs: list, ys: list, forward: np.ndarray, backward: np.ndarray, max_lag: int = 5000) -> np.ndarray:
    """Similarity within the lag limit of all rows of ``xs`` with all of ``ys``, in the order of arguments that ``forward`` (x, y) or ``backward`` (y, x) tells; 0 for other pairs and empty windows."""
    out = np.zeros((len(xs), len(ys)))
    for at_x, at_y, x, y in heads(xs, ys):
        n = x.shape[1]
        lags = np.arange(-(n // 2), (n - 1) // 2 + 1)
        lags = lags[np.abs(lags) <= max_lag]
        here = np.ix_(at_x, at_y)
        if n > DIRECT:
            p, q, r = Spectra(x), Spectra(y), np.zeros((len(x), len(y)))
            i, j = np.nonzero(forward[here])
            r[i, j] = p.best(q, i, j, lags, 1e-12)
            i, j = np.nonzero(backward[here])
            r[i, j] = q.best(p, j, i, lags, 1e-12)
        else:
            u, v, both = unit(x), unit(y), np.isin(lags, -lags)
            r = lag_products(u, v, lags[both])
            if not both.all():  # the lag that only one order of arguments has
                edge = np.where(forward[here], lag_products(u, v, lags[~both]), lag_products(u, v, -lags[~both]))
                r = np.maximum(r, edge)
            scale = n * x.std(1)[:, None] * y.std(1)[None, :]
            r = np.where((scale > 0) & (forward[here] | backward[here]), r * (scale / (scale + 1e-12)), 0.0)
        out[here] = r
    return out


def bounded_matrix(x: np.ndarray, max_lag: int = 5000) -> np.ndarray:
    """Similarity within the lag limit of all rows i < j, in that order of arguments, mirrored; zeros on the diagonal."""
    n, length = x.shape
    out = np.zeros((n, n))
    if length:
        s = Spectra(x)
        lags = np.arange(-(length // 2), (length - 1) // 2 + 1)
        lags = lags[np.abs(lags) <= max_lag]
        for i in range(n - 1):
            j = np.arange(i + 1, n)
            out[i, j] = out[j, i] = s.best(s, np.full(len(j), i), j, lags, 1e-12)
    return out


def condensed_distances(x: np.ndarray, max_lag: int = 5000) -> np.ndarray:
    """One less the similarity of ``bounded_matrix``, from 0 to 1 in steps of 1e-12, of rows i < j in row order: four bytes for each entry of the matrix.

    The steps keep distances to equal rows equal, whichever way they were summed.
    """
    n, length = x.shape
    out = np.zeros(n * (n - 1) // 2)
    if length:
        lags, at = np.arange(-(length // 2), (length - 1) // 2 + 1), 0
        lags = lags[np.abs(lags) <= max_lag]
        s, u, sd = (None, unit(x), x.std(1)) if length <= DIRECT else (Spectra(x), None, None)
        for lo in range(0, n - 1, ROWS):
            hi = min(n - 1, lo + ROWS)
            r = None if u is None else lag_products(u[lo:hi], u[lo:], lags)
            for i in range(lo, hi):
                j = np.arange(i + 1, n)
                if u is None:
                    own = s.best(s, np.full(len(j), i), j, lags, 1e-12)
                else:
                    scale = length * sd[i] * sd[j]
                    own = r[i - lo, j - lo] * (scale / (scale + 1e-12))
                out[at : at + len(j)] = own
                at += len(j)
    np.subtract(1, out, out=out)
    return np.round(np.clip(out, 0, 1, out=out), 12, out=out)


def average_linkage(distance: np.ndarray, cut: float) -> np.ndarray:
    """Labels, numbered by first appearance, of average-linkage clusters cut at ``distance <= cut``.

    Distances lie in one condensed array. Each cluster knows its nearest one after it, so
    a merge looks at one distance a cluster; only clusters whose nearest has merged look
    at their row again. Of equal distances the first pair in row order merges.
    ``distance`` is a matrix, or such an array, which is used up.
    """
    ready = distance.ndim == 1
    n = round((1 + np.sqrt(1 + 8 * len(distance))) / 2) if ready else len(distance)
    start = np.arange(n) * n - np.arange(n) * (np.arange(n) + 1) // 2 - np.arange(n) - 1  # start[i] + j is the place of (i, j)
    d = distance if ready else np.empty(n * (n - 1) // 2)
    near, least = np.full(n, -1), np.full(n, np.inf)
    row = lambda i: d[start[i] + i + 1 : start[i] + n]

    def look(i: int) -> None:
        r = row(i)
        if len(r):
            k = int(r.argmin())
            near[i], least[i] = i + 1 + k, r[k]

    for i in range(n - 1):
        if not ready:
            row(i)[:] = distance[i, i + 1 :]
        look(i)
    label, size, alive = np.arange(n), np.ones(n), np.ones(n, bool)
    while n > 1:
        i = int(least.argmin())
        if not least[i] <= cut:
            break
        j = int(near[i])
        alive[j] = False
        k = np.flatnonzero(alive)
        k = k[k != i]
        at_i, at_j = (start[np.minimum(k, x)] + np.maximum(k, x) for x in (i, j))
        d[at_i] = (size[i] * d[at_i] + size[j] * d[at_j]) / (size[i] + size[j])
        d[at_j], d[start[i] + j] = np.inf, np.inf
        size[i] += size[j]
        least[j], near[j] = np.inf, -1
        label[label == j] = i
        before = k[k < i]
        new = d[start[before] + i]
        closer = (new < least[before]) | ((new == least[before]) & (i < near[before]))
        stale = np.isin(near[before], (i, j)) & ~closer
        near[before[closer]], least[before[closer]] = i, new[closer]
        between = k[(k > i) & (k < j)]
        for x in [*before[stale], i, *between[near[between] == j]]:
            look(int(x))
    seen: dict[int, int] = {}
    return np.array([seen.setdefault(int(x), len(seen)) for x in label], dtype=np.int64)


def spectrum_udf(top: int):
    """The ``top`` strongest frequencies, strongest first, lowest first on ties; zeros for a window without duration."""

    @F.pandas_udf("array<double>")
    def run(signal: pd.Series, seconds: pd.Series) -> pd.Series:
        out = [None] * len(signal)
        for at, x, t in by_length(signal, seconds):
            a = amplitudes(x, t) if x.shape[1] else np.zeros((len(at), len(FREQUENCIES)))
            lasts = t[:, -1] > t[:, 0] if x.shape[1] else np.zeros(len(at), bool)
            best = np.argsort(-a, axis=1, kind="stable")[:, :top]
            for k, i in enumerate(at):
                out[i] = FREQUENCIES[best[k]].tolist() if lasts[k] else [0.0] * top
        return pd.Series(out)

    return run


def low_pass_udf(cutoff: float):
    @F.pandas_udf("array<double>")
    def run(signal: pd.Series, seconds: pd.Series) -> pd.Series:
        out = [None] * len(signal)
        for at, x, t in by_length(signal, seconds):
            y = low_pass(x, t, cutoff)
            for k, i in enumerate(at):
                out[i] = y[k].tolist()
        return pd.Series(out)

    return run


def ncc_udf(full: bool = False, max_lag: int = 5000):
    """Similarity of two arrays; null or unequal lengths are cut to the shorter head."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        n = [min(len(x), len(y)) if x is not None and y is not None else 0 for x, y in zip(a, b)]
        x, y = (pd.Series([np.asarray(v[:k], float) if k else np.zeros(0) for v, k in zip(s, n)]) for s in (a, b))
        for at, p, q in by_length(x, y):
            out[at] = ncc_full(p, q) if full else ncc_bounded(p, q, max_lag)
        return pd.Series(out)

    return run


def peaks_udf(width: int = 1, ratio: float = 400.0):
    @F.pandas_udf("bigint")
    def run(signal: pd.Series) -> pd.Series:
        return signal.map(lambda x: two_means_peaks(np.asarray(x, float), width, ratio))

    return run


# Entropy, dominant ratio and autocorrelation of noise and of a sine.
NOISE, SINE = (0.95, 0.002, 0.03), (0.002, 0.99, 0.95)


def shapes(x: np.ndarray, dt: np.ndarray, low_s: float = 0.001, high_s: float = 0.05) -> np.ndarray:
    """Per row: spectral entropy over its greatest, the share of the strongest frequency, and the greatest autocorrelation at lags from ``low_s`` to ``high_s``.

    The mean is left out of all three; zeros for constant windows, and an autocorrelation of
    0 where no lag lies in the range.
    """
    n = x.shape[1]
    out = np.zeros((len(x), 3))
    if n < 3:
        return out
    c = x - x.mean(1, keepdims=True)
    power = np.abs(np.fft.rfft(c, axis=1))[:, 1:] ** 2
    total = power.sum(1)
    live = (c**2).sum(1) > 1e-12 * np.maximum((x**2).sum(1), 1e-300)
    p = power / np.where(live, total, 1.0)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        out[:, 0] = -np.where(p > 0, p * np.log(p), 0.0).sum(1) / np.log(p.shape[1])
    out[:, 1] = p.max(1)
    size = 1 << (2 * n - 1).bit_length()
    r = np.fft.irfft(np.abs(np.fft.rfft(c, size)) ** 2, size)[:, :n] / np.where(live, (c**2).sum(1), 1.0)[:, None]
    for k in range(len(x)):
        if dt[k] > 0:
            lags = np.arange(int(np.ceil(low_s / dt[k] - 1e-9)), min(int(np.floor(high_s / dt[k] + 1e-9)), n - 1) + 1)
            out[k, 2] = r[k, lags[lags > 0]].max(initial=0.0) if len(lags) else 0.0
    return np.where(live[:, None], out, 0.0)


def shape_udf(low_s: float = 0.001, high_s: float = 0.05):
    """``entropy, dominant, autocorrelation`` and ``is_sine`` (nearer to a sine than to noise) of ``signal`` at ``seconds``."""

    @F.pandas_udf("entropy double, dominant double, autocorrelation double, is_sine boolean")
    def run(signal: pd.Series, seconds: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(signal), 3))
        for at, x, t in by_length(signal, seconds):
            n = x.shape[1]
            out[at] = shapes(x, (t[:, -1] - t[:, 0]) / (n - 1) if n > 1 else np.zeros(len(at)), low_s, high_s)
        far = [((out - np.array(ref)) ** 2).sum(1) for ref in (NOISE, SINE)]
        return pd.DataFrame({"entropy": out[:, 0], "dominant": out[:, 1], "autocorrelation": out[:, 2], "is_sine": far[1] < far[0]})

    return run
