"""SHA-256 over columns of equal rows, with states that can be kept and resumed.

hashlib can copy a running hash but not write it down.  Here a state is eight
32-bit words, so a table can hold it and another task can go on from it.  All
functions work on ``(words, rows)`` arrays of unsigned 32-bit integers; a child
of a tree is the 64 hex characters of its digest, which is one block exactly.
"""

from __future__ import annotations

import math

import numpy as np

BLOCK = 64


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** 3 <= x else (low, mid - 1)
    return low


# the first 32 bits of the fractional parts of the primes' square and cube roots
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
# four hex characters of each 16-bit number, as one word
HEX4 = np.frombuffer("".join(f"{i:04x}" for i in range(1 << 16)).encode(), ">u4").astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def start(rows: int) -> np.ndarray:
    """The state before any block."""
    return np.repeat(START[:, None], rows, axis=1)


def step(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The state after one more block: (8, rows) and (16, rows) words."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w.append(w[t - 16] + w[t - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                 + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        one = (h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[t] + w[t])
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digest words of messages of ``blocks`` whole blocks."""
    end = np.zeros((16, state.shape[1]), np.uint32)
    end[0] = 1 << 31
    end[15] = blocks * (BLOCK * 8)
    return step(state, end)


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digest words as the block of their 64 hex characters."""
    out = np.empty((16, digest.shape[1]), np.uint32)
    out[0::2] = HEX4[digest >> np.uint32(16)]
    out[1::2] = HEX4[digest & np.uint32(0xFFFF)]
    return out


def to_bytes(words: np.ndarray) -> bytes:
    """32 bytes of each row, row after row."""
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    """(8, rows) words of 32-byte rows."""
    return np.ascontiguousarray(np.frombuffer(raw, ">u4").reshape(-1, 8).T).astype(np.uint32)
