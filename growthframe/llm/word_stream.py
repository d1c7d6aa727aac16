"""Words of joined texts and their hashes, without a Python step for each word (numpy only)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of joined texts that are taken at a time.
CHUNK = 1 << 19


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words (letters and digits, and all beyond ASCII), and a random value for each; A-Z as a-z."""
    word = np.zeros(256, bool)
    word[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    value = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
    value[65:91] = value[97:123]
    return word, value


_WORD, _VALUE = _tables()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << int(n).bit_length())
    if size not in _POWERS:
        _POWERS[size] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, _INVERSE))
    return _POWERS[size]


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in turn, and the text of each."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = _WORD[data]
    change = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    begin, end = change[::2], change[1::2]
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:len(data)], out=total[1:])
    h = (total[end] - total[begin]) * down[begin]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return h, np.searchsorted(bounds, begin, "right")


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about CHUNK bytes, with the number of the first; a longer text stands alone."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield first, texts[first:k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]
