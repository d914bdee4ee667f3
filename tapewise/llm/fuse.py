"""Static three-way binary fuse filters over 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import math

import numpy as np

from tapewise.llm.common import by_value

U = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of key + seed."""
    x = keys + U(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> U(shift))) * U(factor)
    return x ^ (x >> U(33))


def shape(n: int) -> tuple[int, int]:
    """Segment length and number of starting segments for ``n`` keys."""
    length = min(1 << 18, 1 << int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return length, max(1, -(-int(round(n * factor)) // length) - 2)


def slots(hashed: np.ndarray, length: int, count: int) -> np.ndarray:
    """The three table positions of each hash, in three neighbouring segments."""
    first = ((hashed >> U(32)) * U(count * length)) >> U(32)
    mask = U(length - 1)
    second = (first + U(length)) ^ ((hashed >> U(18)) & mask)
    third = (first + U(2 * length)) ^ (hashed & mask)
    return np.stack([first, second, third]).astype(np.int64)


def prints(hashed: np.ndarray) -> np.ndarray:
    return (hashed ^ (hashed >> U(32))).astype(np.uint16)


def build(keys: np.ndarray, tries: int = 100) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segment count and table of 16-bit prints for distinct keys."""
    keys = np.unique(keys)
    length, count = shape(len(keys))
    for seed in range(1, tries + 1):
        hashed = mix(keys, seed)
        at = slots(hashed, length, count)
        size = (count + 2) * length
        degree = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        index = np.arange(len(keys))
        for row in at:
            np.bitwise_xor.at(owner, row, index)
        waves, ready, left = [], np.flatnonzero(degree == 1), len(keys)
        while len(ready):
            # a key alone in one of its slots can be placed last there; all such keys of a wave are independent
            key, first = np.unique(owner[ready], return_index=True)
            waves.append((key, ready[first]))
            left -= len(key)
            touched = at[:, key]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(owner, row, key)
            ready = np.unique(touched)
            ready = ready[degree[ready] == 1]
        if left:
            continue
        table, mark = np.zeros(size, np.uint16), prints(hashed)
        for key, slot in reversed(waves):
            a, b, c = at[:, key]
            table[slot] = mark[key] ^ table[a] ^ table[b] ^ table[c]
        return seed, length, count, table.tobytes()
    raise RuntimeError("no seed peels the keys")


def probe(keys: np.ndarray, seed: int, length: int, count: int, table: bytes) -> np.ndarray:
    """True where a key may be in the filter (always for its members)."""
    cells, hashed = np.frombuffer(table, np.uint16), mix(keys, seed)
    a, b, c = slots(hashed, length, count)
    return (cells[a] ^ cells[b] ^ cells[c]) == prints(hashed)


by_value(__name__)
