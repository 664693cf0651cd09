"""Words of whole UTF-8 texts as numpy arrays.

A batch of texts is one byte buffer with the texts' bounds. Word starts, ends and 64-bit hashes come
from array operations on that buffer, a quarter of a megabyte at a time, so that neither a long text
nor many words make Python objects.

A word's hash is a polynomial over random values of its bytes, modulo 2**64, mixed at the end. A-Z
have the values of a-z. Unequal words share a hash with a chance of about 2**-60 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANKS = b" \t\n\x0b\x0c\r"
# Everything ASCII that is neither a digit nor a letter.
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())
STEP = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


@dataclass(frozen=True)
class Words:
    """Words of a batch: the words of text d are those from first[d] up to first[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, k: int) -> bytes:
        """The bytes of word k, A-Z lower-cased."""
        return self.data[self.start[k]:self.end[k]].tobytes().lower()


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the bounds between them; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), bounds


class Splitter:
    """Splits texts into words, the runs of bytes that are not ``separators``."""

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        self.values = np.random.default_rng(20260101).integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.values[ord("A"):ord("Z") + 1] = self.values[ord("a"):ord("z") + 1]
        self._up = self._down = np.zeros(0, np.uint64)

    def __getstate__(self):
        return self.__dict__ | {"_up": np.zeros(0, np.uint64), "_down": np.zeros(0, np.uint64)}

    def _scales(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, max(n, STEP)), _powers(pow(_BASE, -1, 1 << 64), max(n, STEP))
        return self._up[:n], self._down

    def _cut(self, data: np.ndarray, bounds: np.ndarray, at: int, stop: int) -> int:
        """Where a step that begins at ``at`` can end without cutting a word."""
        reach = STEP
        while at + reach < stop:
            blank = np.flatnonzero(~self.inside[data[at:at + reach]])
            edge = int(bounds[np.searchsorted(bounds, at + reach, "right") - 1])
            cut = max(at + int(blank[-1]) + 1 if len(blank) else at, edge)
            if cut > at:
                return cut
            reach *= 2
        return stop

    def __call__(self, texts: pa.Array) -> Words:
        data, bounds = buffer_of(texts)
        at, stop = int(bounds[0]), int(bounds[-1])
        starts, ends, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        while at < stop:
            cut = self._cut(data, bounds, at, stop)
            part = data[at:cut]
            inside = self.inside[part]
            begins, ceases = inside.copy(), inside.copy()
            begins[1:] &= ~inside[:-1]
            ceases[:-1] &= ~inside[1:]
            edges = bounds[np.searchsorted(bounds, at, "right"):np.searchsorted(bounds, cut, "left")] - at
            begins[edges] = inside[edges]
            ceases[edges - 1] = inside[edges - 1]
            s, e = np.flatnonzero(begins), np.flatnonzero(ceases) + 1
            up, down = self._scales(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * up, out=sums[1:])
            starts.append(s + at)
            ends.append(e + at)
            keys.append(mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
            at = cut
        start = np.concatenate(starts)
        return Words(data, start, np.concatenate(ends), np.concatenate(keys), np.searchsorted(start, bounds))


def pieces(texts: pa.Array, most: int = 2 << 20) -> list[tuple[int, int]]:
    """Start and length of runs of texts of about ``most`` bytes each, and never less than one text."""
    _, bounds = buffer_of(texts)
    found, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        found.append((at, min(to, len(texts)) - at))
        at += found[-1][1]
    return found
