"""Vectorised polynomial hashes over byte buffers (numpy, inside tasks).

``prefix`` gives P[i] = sum of (b[j] + 1) * B^j for j < i (mod 2^64). The hash
of b[s:e] is (P[e] - P[s]) * B^-s, so every substring hash is three
operations; B is odd and therefore invertible."""

from __future__ import annotations

import functools

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1


@functools.lru_cache(maxsize=2)
def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(n: int, base: int) -> np.ndarray:
    size = 1 << max(16, (n - 1).bit_length())
    return powers(size, base)[:n]


def prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), BASE), out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift multiplications)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def mix_in(h: np.ndarray, work: np.ndarray) -> None:
    """``mix`` in place, with a work array of the same size."""
    for _ in range(2):
        np.right_shift(h, np.uint64(32), out=work)
        h ^= work
        h *= np.uint64(0xD6E8FEB86659FD93)
    np.right_shift(h, np.uint64(32), out=work)
    h ^= work


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end)."""
    inv = _powers(int(start.max()) + 1 if len(start) else 1, INVERSE)
    return mix((p[end] - p[start]) * inv[start] + (end - start).astype(np.uint64))


#: Bytes that belong to words: 0-9, a-z and everything outside ASCII.
WORD_BYTE = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])


def words(text: bytes) -> np.ndarray:
    """Hash of every word of a text (A-Z lower-cased; words are maximal runs
    of 0-9, a-z and non-ASCII characters), in order."""
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = WORD_BYTE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return spans(prefix(data), start, end)


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of k consecutive words; a text of fewer words,
    but not none, is one shingle."""
    w = words(text)
    if not len(w):
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(BASE) + w[i:i + n])
    return np.unique(h)


def distinct(values: np.ndarray) -> np.ndarray:
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


def minhash(values: np.ndarray, starts: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """(rows, hashes) matrix of 32-bit minima; row i covers
    values[starts[i]:starts[i + 1]], none of them empty. The values are mixed
    hashes already, so a multiplication and an addition permute them well
    enough. Works in cache-sized runs of whole rows."""
    low = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
    out = np.empty((len(starts) - 1, len(multipliers)), dtype=np.uint32)
    row, step = 0, 1 << 16
    work = np.empty(step, dtype=np.uint32)
    while row < len(starts) - 1:
        last = max(row + 1, int(np.searchsorted(starts, starts[row] + step, "right")) - 1)
        part, at = low[starts[row]:starts[last]], starts[row:last] - starts[row]
        if len(part) > len(work):
            work = np.empty(len(part), dtype=np.uint32)
        for j, (a, b) in enumerate(multipliers):
            np.multiply(part, a, out=work[:len(part)])
            np.add(work[:len(part)], b, out=work[:len(part)])
            out[row:last, j] = np.minimum.reduceat(work[:len(part)], at)
        row = last
    return out


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of pairwise intersections of sorted distinct arrays
    (none empty); the diagonal is not set for small inputs."""
    m = len(sets)
    if m <= 8:  # a few binary searches cost less than numbering all values
        out = np.zeros((m, m))
        for i in range(m):
            for j in range(i + 1, m):
                at = np.minimum(np.searchsorted(sets[j], sets[i]), len(sets[j]) - 1)
                out[i, j] = out[j, i] = np.count_nonzero(sets[j][at] == sets[i])
        return out
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    out = np.zeros((m, m), dtype=np.float64)
    width = max(1, min((1 << 22) // m, 1 << 16))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((m, width), dtype=np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        out += dense @ dense.T
    return out


def multipliers(n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 1 << 32, size=(n, 2), dtype=np.uint32)
    out[:, 0] |= 1
    return out
