"""Words of a text and their 64-bit hashes, by a per-worker memory of words."""

from __future__ import annotations

import numpy as np
import xxhash

_ROOM = 150_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < _ROOM:
            self[word] = h
        return h


_hashes = _Hashes()


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_hashes) >= _ROOM and len(words) > 0:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _MIX[0]
        h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle, none without words."""
    h = word_hashes(split_words(text))
    if not len(h):
        return h
    width = min(size, len(h))
    with np.errstate(over="ignore"):
        total = np.full(len(h) - width + 1, np.uint64(width))
        for k, m in enumerate(multipliers(size, 5)[:width]):
            total += h[k:len(h) - width + 1 + k] * m
    return np.unique(mix(total))
