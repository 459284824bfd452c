"""Vectorised hashing of byte spans, for operators that compare texts.

The hash of a span is the sum of a random 64-bit value for each byte times a
power of an odd base, shifted to the span's start: with prefix sums, all spans
of a batch cost a few array operations. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 2**64)


def _rng_table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out, dtype=np.uint64)


_BYTE = _rng_table(7, 256)
_TABLES: dict[str, np.ndarray] = {}


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser (xor-shift and multiply)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 2**20)
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES["up"], _TABLES["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]`` (bytes); equal bytes have
    equal hashes."""
    up, down = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, pointers): the words of text ``i`` (maximal runs without blanks)
    have the hashes ``hashes[pointers[i]:pointers[i + 1]]``."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    blank = _BLANK[data]
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    after = np.cumsum([len(t) + 1 for t in texts])
    ptr = np.concatenate([[0], np.searchsorted(starts, after, side="left")]).astype(np.int64)
    return span_hashes(data, starts, ends), ptr


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``width`` consecutive words, after
    lower-casing A-Z; with fewer words, of the whole sequence; without words,
    empty."""
    words, ptr = words_of([t.encode("utf-8", "surrogatepass").lower() for t in texts])
    n = len(words)
    rolled = np.zeros(n, dtype=np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        rolled[: max(0, n - k)] = rolled[: max(0, n - k)] * step + words[k:]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(ptr[:-1], ptr[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = np.uint64((int(h) * 0x9E3779B97F4A7C15 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix64(np.array([h], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Number of common values of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())
