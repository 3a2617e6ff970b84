"""A minimal perfect hash over 64-bit keys, built and asked with numpy.

Keys go through levels of bit arrays. On each level a key that meets no other key at its
place sets its bit and is done; the others go on. A key's number is the count of bits set
before its own.
"""

import numpy as np

_LOAD = 2.0


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """The keys, scrambled differently on each level."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> list[np.ndarray]:
    """The levels, each an array of bits, for distinct unsigned 64-bit keys."""
    levels = []
    while len(keys):
        size = max(int(len(keys) * _LOAD), 2)
        places = (_mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(places, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[places]]
    return levels


def numbers(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The number of each key, 0 to n - 1. A key the hash was not built for gets any number
    or -1."""
    found = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        places = (_mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[places]
        rank = np.cumsum(bits)
        found[open_[hit]] = base + rank[places[hit]] - 1
        open_, base = open_[~hit], base + int(rank[-1])
    return found


def packed(levels: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    """The levels for a table row: their sizes, and their bits in bytes."""
    return [len(b) for b in levels], [np.packbits(b).tobytes() for b in levels]


def unpacked(sizes, bits) -> list[np.ndarray]:
    return [
        np.unpackbits(np.frombuffer(b, np.uint8), count=int(n)).astype(bool)
        for n, b in zip(sizes, bits)
    ]
