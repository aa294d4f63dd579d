"""Words of many texts at once, as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np

#: White space between words: space, and tab to carriage return.
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE, _BASE2 = 0x100000001B3, 0x9E3779B97F4A7C15
_TABLES: dict[int, np.ndarray] = {}
_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    """The first powers of an odd base modulo 2^64, at least n."""
    if len(_TABLES.get(base, ())) < n:
        factors = np.full(2 * n + 1, base, np.uint64)
        factors[0] = 1
        _TABLES[base] = np.cumprod(factors, dtype=np.uint64)
    return _TABLES[base]


def mix(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes, and a number for each that depends on its bytes alone."""
    solid = np.concatenate([[False], ~IS_SPACE[raw], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw))[:len(raw)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * _powers(pow(_BASE, -1, 1 << 64), len(raw))[starts])


def string_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each string in the bytes, of 64 and 32 bits; unlike strings may share both, so compare the bytes."""
    raw, out = raw.astype(np.uint64) + np.uint64(1), []
    for base in (_BASE, _BASE2):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(raw * _powers(base, len(raw))[:len(raw)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * _powers(pow(base, -1, 1 << 64), len(raw))[starts]))
    return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of ``size`` words, and where each text's begin (one more than texts).

    A text with fewer words has one run, of all its words; one without words has none.
    """
    starts, _, names = words(np.frombuffer(b" ".join(texts), np.uint8))
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    first = np.searchsorted(starts, begins)  # of each text's words
    n = np.diff(first)
    runs = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(offsets[-1]) + np.repeat(first[:-1] - offsets[:-1], runs)
    end = np.repeat(first[1:], runs)
    out = np.zeros(len(at), np.uint64)
    padded = np.append(names, np.zeros(size, np.uint64))
    for j in range(size):
        word = np.where(at + j < end, padded[at + j], np.uint64(0))
        out = (out + word) * (_GOLDEN + np.uint64(2 * j))
    return mix(out), offsets


def counted(numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the distinct numbers, ascending, and how often each occurs; and where each text's begin."""
    found = [np.unique(numbers[a:b], return_counts=True) for a, b in zip(offsets[:-1], offsets[1:])]
    if not found:
        return numbers, np.empty(0, np.int64), offsets
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), np.concatenate([[0], np.cumsum([len(f[0]) for f in found])])
