"""Hashes of words and of byte ranges, for whole slices of texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# A polynomial over random letters modulo 2^64: hash(a..b) = sum(letter[t[i]] * BASE^(i - a)).
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i up to ``size``, a power of two."""
    with np.errstate(over="ignore"):
        up = np.full(size + 1, _BASE, np.uint64)
        down = np.full(size + 1, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """``h`` with high and low bits spread."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h ^= h >> np.uint64(29)
    return h


class Ranges:
    """Hashes of arbitrary ranges of a sequence of bytes (uint8) or of hashed words (uint64)."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self.down = _powers(max(1 << 20, 1 << int(n).bit_length()))
        letters = _letters()[values] if values.dtype == np.uint8 else values | np.uint64(1)
        self.upto = np.zeros(n + 1, np.uint64)
        np.cumsum(letters * up[:n], out=self.upto[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.upto[end] - self.upto[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all ranges of ``size``."""
        n = len(self.upto) - size
        return mixed((self.upto[size:] - self.upto[:n]) * self.down[:n])


def _separators(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


BLANK = _separators(b"\x20\x09\x0a\x0b\x0c\x0d")
# Everything in ASCII but letters and digits.
PUNCTUATION = _separators(bytes(b for b in range(128) if not chr(b).isalnum()))
# Bytes with A-Z as a-z.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Words:
    """The words of several texts: hash, and first and last byte in the joined buffer.

    ``doc`` gives each word's text. Words never cross texts.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray, lower: bool = False):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        # a blank after each text keeps its last word apart from the next text
        self.buffer = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        if lower:
            self.buffer = LOWER[self.buffer]
        self.first_byte = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = np.concatenate([[False], ~separators[self.buffer], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.hash = Ranges(self.buffer).hash(self.start, self.end)
        self.first = np.searchsorted(self.start, self.first_byte)  # first word of each text, and the number of all
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
