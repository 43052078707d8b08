"""Word shingles as hashes, and their minima under universal hash functions."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest, xxh3_128_digest

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = 0x9E3779B1
_BLOCK = 512


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of `width` words."""
    n = len(hashes) - width + 1
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= _STEP
        out += hashes[k:n + k]
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct shingles of a text, A-Z lower-cased; a shorter text is one shingle, no words none.

    bytes.split() cuts at exactly the blanks x20 and x09-x0D, and bytes.lower() changes A-Z only.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(width, len(words))))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    key = np.frombuffer(xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(key[0]), int(key[1])


class Minima:
    """`count` minima under multiply-add functions over 32-bit shingle hashes."""

    def __init__(self, count: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.a = (draw.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = draw.integers(0, 1 << 32, count, np.uint32)[:, None]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), _BLOCK):
            np.minimum(least, (self.a * x[at:at + _BLOCK] + self.b).min(axis=1), out=least)
        return least


def signature_bytes(minima: np.ndarray) -> bytes:
    """One byte of each minimum, taken from a product since the minima of long texts are all small."""
    return ((minima * np.uint32(_SPREAD)) >> np.uint32(24)).astype(np.uint8).tobytes()


def band_keys(minima: np.ndarray, rows: int) -> list[int]:
    """A signed 64-bit key of each band of `rows` minima, different for each band."""
    data, width = minima.tobytes(), 4 * rows
    keys = [xxh3_64_intdigest(data[at:at + width], at) for at in range(0, len(data), width)]
    return np.array(keys, np.uint64).view(np.int64).tolist()
