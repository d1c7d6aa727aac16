"""Bucket identifiers of q-grams at every byte, and the sampled suffixes that stand for all others (numpy only)."""

from __future__ import annotations

import numpy as np

#: Bytes of the q-grams that open a bucket.
Q = 64
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_ODD = _RANDOM.integers(0, 1 << 64, (16, 2), np.uint64) | np.uint64(1)


def joined_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one byte array, and where each begins (and the last ends)."""
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([*map(len, texts)])]).astype(np.int64)


def refine(ids: np.ndarray, size: int, level: int) -> np.ndarray:
    """Bucket identifiers of 2 * ``size`` bytes from those of ``size`` bytes: each with the one ``size`` further on."""
    out = ids * _ODD[level, 0]
    out[:-size] += ids[size:]
    out ^= out >> np.uint64(31)
    out *= _ODD[level, 1]
    out ^= out >> np.uint64(29)
    return out


def buckets(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Identifiers of the buckets of every suffix by its first ``sizes`` bytes (powers of two)."""
    ids, size, out = _BYTE[data], 1, {1: None}
    level = 0
    while size < max(sizes):
        ids = refine(ids, size, level)
        size, level = 2 * size, level + 1
        if size in sizes:
            out[size] = ids
    return [out[s] for s in sizes]


def samples(grams: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every ``length``-byte string inside a text, the q-gram in it with the smallest identifier (leftmost of equals).

    Equal strings choose the same place in them, so strings need to be compared with those alone whose
    chosen q-grams are equal. Returns the runs of starts that choose one place: first start, last start, place."""
    n = len(grams)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (grams >> bits << bits) | np.arange(n, dtype=np.uint64)
    width, size = length - Q + 1, 1
    while 2 * size <= width:
        low[:n - size] = np.minimum(low[:n - size], low[size:])
        size *= 2
    rest = width - size
    if rest:
        low[:n - rest] = np.minimum(low[:n - rest], low[rest:])
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    whose = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(whose)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[whose]
    place = (low[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (whose[1:] != whose[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return (at[first], at[last], place[first]) if len(at) else (np.zeros(0, np.int64),) * 3
