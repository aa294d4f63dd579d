"""SHA-256 of many messages at once, in numpy, with states that can be kept and resumed.

A state is what the hash has taken in so far: eight words, 32 bytes. The
messages here are digests as hex text, one after another. Such a digest is 64
bytes, one block, so a state can be kept before each digest and resumed there.
Arrays of states have the shape (8, n), those of digests (n, 32).
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_WORD = (1 << 32) - 1


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** 3 <= x else (low, mid - 1)
    return low


#: Fractions of the square roots of the first primes, and of the cube roots.
START = np.array([isqrt(p << 64) & _WORD for p in _primes(8)], np.uint32)
_ROUNDS = np.array([_cube_root(p << 96) & _WORD for p in _primes(64)], np.uint32)
_HEX = np.array([list(b"%02x" % i) for i in range(256)], np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (8, n) after one more block (16, n) each; either may have n = 1 for all."""
    a, b, c, d, e, f, g, h = states
    w = list(blocks)
    for i, k in enumerate(_ROUNDS):
        if i >= 16:
            x, y = w[(i - 15) % 16], w[(i - 2) % 16]
            w[i % 16] = (w[i % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                         + w[(i - 7) % 16] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        mixed = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (w[i % 16] + k)
        major = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = mixed + major, a, b, c, d + mixed, e, f, g
    return np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h)) + states


def begin(n: int) -> np.ndarray:
    """States that have taken in nothing."""
    return np.repeat(START[:, None], n, axis=1)


def text(digests: np.ndarray) -> np.ndarray:
    """Digests as hex text, (n, 64) bytes."""
    return _HEX[digests].reshape(len(digests), 64)


def take(states: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after a digest each, as hex text."""
    return compress(states, text(digests).view(">u4").astype(np.uint32).T)


def finish(states: np.ndarray, taken: int) -> np.ndarray:
    """The digests (n, 32) of states that have taken in ``taken`` digests."""
    last = np.zeros((16, 1), np.uint32)
    last[0], last[15] = 1 << 31, taken * 512
    return np.ascontiguousarray(compress(states, last).T).astype(">u4").view(np.uint8)


def packed(states: np.ndarray) -> bytes:
    """States as bytes, 32 each."""
    return np.ascontiguousarray(states.T).astype("<u4").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4").reshape(-1, 8).T.astype(np.uint32)
