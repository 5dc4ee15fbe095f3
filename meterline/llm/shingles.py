"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of letters and digits of the lower-cased text. Its hash is a polynomial over random
values of its characters, found for all words of a chunk of texts from one running sum.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SHINGLE = 5

#: Characters that are hashed together; a longer text is a chunk of its own.
CHUNK = 400_000

_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Tables:
    """Per worker process: letters and digits, a random value per character, powers of the base."""

    def __init__(self):
        points = sys.maxunicode + 1
        self.is_word = np.fromiter(
            (chr(c).isalnum() for c in range(points)), np.bool_, points
        )
        self.value = mix(np.arange(1, points + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.power = self.inverse = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, CHUNK + 1)
            for name, base in (("power", _BASE), ("inverse", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_tables: _Tables | None = None


def tables() -> _Tables:
    global _tables
    if _tables is None:
        _tables = _Tables()
    return _tables


@dataclass
class Hashes:
    """``values[offsets[k]:offsets[k + 1]]`` belong to text ``first + k``."""

    first: int
    values: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, k: int) -> np.ndarray:
        return self.values[self.offsets[k] : self.offsets[k + 1]]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hashes(texts: list[str], most: int = CHUNK) -> Iterator[Hashes]:
    """The words of all texts, a chunk of texts at a time."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= most):
            size += len(texts[end]) + 1
            end += 1
        yield _chunk(texts[start:end], start)
        start = end


def _chunk(texts: list[str], first: int) -> Hashes:
    table = tables()
    lower = [t.lower() for t in texts]
    points = code_points("\n".join(lower) + "\n")
    ends_of_texts = np.cumsum([len(t) + 1 for t in lower])
    table.reach(len(points) + 1)
    inside = table.is_word[points]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.insert(edges, 0, 0)
    starts, ends = edges[::2], edges[1::2]  # the last character is a line end
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(table.value[points] * table.power[: len(points)], out=sums[1:])
    values = mix((sums[ends] - sums[starts]) * table.inverse[starts])
    offsets = np.concatenate([[0], np.searchsorted(starts, ends_of_texts)])
    return Hashes(first, values, offsets)


def shingle_hashes(words: Hashes, size: int = SHINGLE) -> Hashes:
    """One hash per window of ``size`` words; a shorter text is one window of all its words."""
    counts = np.diff(words.offsets)
    wide = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(wide)])
    total = len(words.values)
    padded = np.concatenate([words.values, np.zeros(size, np.uint64)])
    # the window that starts at each kept word
    at = np.arange(offsets[-1]) + np.repeat(words.offsets[:-1] - offsets[:-1], wide)
    rolled = np.zeros(total, np.uint64)
    for k in range(size):
        rolled = mix(rolled + padded[k : k + total] + np.uint64(0x9E3779B97F4A7C15))
    values = rolled[at]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        one = np.zeros(1, np.uint64)
        for w in words.of(k):
            one = mix(one + w + np.uint64(0x9E3779B97F4A7C15))
        values[offsets[k]] = one[0]
    return Hashes(words.first, values, offsets)


def shingles_of(text: str, size: int = SHINGLE) -> np.ndarray:
    return shingle_hashes(next(word_hashes([text])), size).values
