"""Vectorised hashes of the words, shingles and byte windows of one text (numpy, used inside tasks).

All hashes are fixed functions of the bytes: they name equal strings equally in every task and run.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MASK = 2**64 - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


_BYTE = mix(np.arange(1, 257, dtype=U64) * _BASE) | U64(1)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, U64(base), dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _table(base: U64, length: int) -> np.ndarray:
    """Powers of ``base`` for at least ``length`` positions; sizes are powers of two so few tables exist."""
    return _powers(int(base), max(1 << 12, 1 << (length - 1).bit_length()))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word."""
    if not words:
        return np.empty(0, U64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(len(data)) - np.repeat(starts, lengths)
    terms = _BYTE[data] * _table(_BASE, int(lengths.max()) + 1)[inside]
    return mix(np.add.reduceat(terms, starts) + lengths.astype(U64))


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, U64)
    out = np.full(count, U64(size), dtype=U64)
    for i in range(size):
        out = out * _BASE + words[i : i + count]
    return mix(out)


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; bytes.split and bytes.lower do exactly that on UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words count as one shingle, none as the empty set."""
    words = word_hashes(ascii_words(text))
    if not len(words):
        return words
    return np.unique(sequence_hashes(words, min(size, len(words))))


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    """128-bit name of a sorted set, as two signed longs."""
    order = mix(hashes + U64(len(hashes)))
    first = int(np.bitwise_xor.reduce(order)) if len(order) else 0
    second = int(np.add.reduce(mix(order + _BASE))) & _MASK if len(order) else 0
    return tuple(v - 2**64 if v >= 2**63 else v for v in (first, second))


class Windows:
    """Prefix sums over a byte string that hash any of its spans in constant time."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE[data] * _table(_BASE, len(data) + 1)[: len(data)], out=self.sums[1:])
        self.shift = _table(_BASE_INVERSE, len(data) + 1)

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        value = (self.sums[stop] - self.sums[start]) * self.shift[start]
        return mix(value + (stop - start).astype(U64) * _BASE)

    def all_of(self, length: int) -> np.ndarray:
        """Hash of every span of ``length`` bytes."""
        count = len(self.sums) - length
        if count <= 0:
            return np.empty(0, U64)
        value = (self.sums[length:] - self.sums[:count]) * self.shift[:count]
        return mix(value + U64((length * int(_BASE)) & _MASK))
