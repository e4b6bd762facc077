"""NumPy kernels over Arrow string buffers: words, hashes and shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step works on; a longer text is one step of its own.
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the result."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: A random-looking 64-bit value for each byte.
BYTES = mix((np.arange(256, dtype=np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))
#: Another one, for a second hash of the same strings.
OTHERS = mix(BYTES ^ U(0x5851F42D4C957F2D))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 4096)
        for k, b in enumerate((BASE, INVERSE)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column, without a copy; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def steps(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes each."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def prefix(buf: np.ndarray, values: np.ndarray = BYTES) -> np.ndarray:
    """Running sums of the byte values times powers; a zero comes first."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * up, out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings from start to end; equal strings have equal hashes wherever they are."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def hashes(column: pa.Array, values: np.ndarray = BYTES) -> np.ndarray:
    """Hash of each byte string, as ``spans`` gives it."""
    buf, off = buffers(column)
    return spans(prefix(buf[off[0] : off[-1]], values), off[:-1] - off[0], off[1:] - off[0])


def words(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, row and hash of all words; offsets begin at 0. Words do not cross rows."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, none.astype(np.uint64)
    space = SPACE[buf]
    edge = np.ones(n + 1, bool)
    edge[1:n] = space[:-1]
    edge[offsets] = True
    start = np.flatnonzero(~space & edge[:n])
    edge = np.ones(n + 1, bool)
    edge[:n] = space
    edge[offsets] = True
    end = np.flatnonzero(~space & edge[1:]) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row, spans(prefix(LOWER[buf] if lower else buf), start, end)


def shingles(row: np.ndarray, h: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word's index in the batch and hash of each run of k words.

    A row with fewer than k words, but at least one, has one shingle of all of them.
    """
    n = len(h)
    if not n:
        return row, row, h
    acc = mix(h)
    total = acc.copy()
    ok = np.zeros(n, bool)
    if n >= k:
        ok[: n - k + 1] = row[: n - k + 1] == row[k - 1 :]
        for j in range(1, k):
            total[: n - j] = total[: n - j] * BASE + acc[j:]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    sizes = np.diff(np.r_[first, n])
    out = mix(total)
    for f, s in zip(first[sizes < k], sizes[sizes < k]):
        t = U(s)
        with np.errstate(over="ignore"):
            for x in acc[f : f + s]:
                t = t * BASE + x
        out[f] = mix(np.array([t], np.uint64))[0]
        ok[f] = True
    at = np.flatnonzero(ok)
    return row[at], at, out[at]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ragged(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets of the sorted row numbers."""
    return np.searchsorted(row, np.arange(n + 1))


def lists(values: np.ndarray | pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))
