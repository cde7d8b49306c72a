"""Word shingles of a whole text as 64-bit hashes, and their MinHash values, vectorised over the text's bytes."""

from __future__ import annotations

import numpy as np

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
_BYTE_WEIGHTS = _RNG.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_WEIGHTS = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: MinHash values per text.
HASHES = 96
_A = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: a sum of its bytes, each times a random odd number of its place."""
    data = np.frombuffer(text, np.uint8)
    inside = ~_IS_SPACE[data]
    start = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])) if data.size else np.empty(0, np.int64)
    if not start.size:
        return np.empty(0, np.uint64)
    end = np.flatnonzero(inside & np.concatenate([~inside[1:], [True]])) + 1
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    return mix(np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * _BYTE_WEIGHTS[place & 4095], first) + length.astype(np.uint64))


def shingles(text: bytes, k: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of k words; a text of fewer words has the run of them all, one without words has none."""
    words = word_hashes(text)
    k = min(k, words.size)
    if not k:
        return words
    n = words.size - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += words[j : j + n] * _WORD_WEIGHTS[j]
    return np.unique(mix(total))


def minhash(found: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """HASHES values of 32 bits. Of two sets, each value is equal with a probability of their Jaccard similarity."""
    out, high = np.full(HASHES, 0xFFFFFFFF, np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, high.size, chunk):
        np.minimum(out, (high[at : at + chunk, None] * _A + _B).min(axis=0), out=out)
    return out


def signature(found: np.ndarray) -> np.ndarray:
    """The lower 16 bits of each MinHash value: those of different sets also agree with a probability of 1 / 65,536."""
    return mix(minhash(found).astype(np.uint64)).astype(np.uint16)


def set_hash(found: np.ndarray) -> bytes:
    """128 bits of hash of a set of shingles."""
    size = np.uint64(found.size)
    return b"".join(mix(np.array([np.bitwise_xor.reduce(mix(found + np.uint64(salt))) + size])).tobytes() for salt in (1, 0x5851F42D4C957F2D))
