"""Word hashes, word shingles and min-hash signatures of texts, in numpy.

Words are maximal runs without ASCII white space of the lower-cased text.  A
shingle is a run of ``SHINGLE`` words; a text with fewer words is one shingle;
a text without words has none.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Coordinates of a signature, and bins of a sketch.
COORDS, BINS = 64, 512

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_ROLE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 32, COORDS, dtype=np.uint64).astype(np.uint32)
_MUL = _rng.integers(0, 1 << 31, COORDS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(z: np.ndarray) -> np.ndarray:
    """64-bit mixing (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to ``n``."""
    if len(_powers[0]) <= n:
        size = max(4096, 2 * n)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                steps = np.full(size, np.uint64(base), np.uint64)
                steps[0] = 1
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word, in order."""
    return byte_word_hashes((text or "").lower().encode("utf-8", "replace"))


def byte_word_hashes(text: bytes) -> np.ndarray:
    """The same for encoded text as it is: a polynomial hash from one running sum over the bytes."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(raw))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])
        return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    with np.errstate(over="ignore"):
        total = words[: len(words) - n + 1] * _ROLE[0]
        for k in range(1, n):
            total = total + words[k : len(words) - n + 1 + k] * _ROLE[k]
        return np.unique(mix(total + np.uint64(n)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Min-hash coordinates (32 bits each) of a non-empty set."""
    h, out = (shingles >> np.uint64(32)).astype(np.uint32), None
    for at in range(0, len(h), 4096):
        part = ((h[at : at + 4096, None] ^ _XOR) * _MUL).min(axis=0)
        out = part if out is None else np.minimum(out, part)
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One byte for each of ``BINS`` hash ranges: part of the smallest hash in it, 0 if it is empty.

    The set is sorted, so a range's smallest hash is its first.
    """
    out = np.zeros(BINS, np.uint8)
    bins = (shingles >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out[bins[first]] = 1 + ((shingles[first] >> np.uint64(16)) % np.uint64(255)).astype(np.uint8)
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two shingle sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 0.0
