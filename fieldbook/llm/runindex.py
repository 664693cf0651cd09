"""A run-compressed Burrows-Wheeler transform of a few megabytes of byte strings, and the long matches in it.

Suffixes of all strings are ordered (a string's end is smaller than any byte and ends the comparison; equal
suffixes stay in the order of the strings). Runs of equal preceding bytes make the compressed transform; of
each run only its first and last row are kept, as samples: the text position there, that of the
neighbouring row outside the run, and the length of the prefix they share.

Within a run a neighbour's match grows by one byte for each step to the left. So matching statistics against
the preceding (following) suffix can be streamed over the text: they restart at the samples of run
starts (run ends) and fall by one a byte in between. The longer of the two is the longest match that
a position has anywhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WORD, _BITS = 7, 9


@dataclass(frozen=True)
class RunIndex:
    """The transform's runs (symbol 0 is a string's start, a byte is its value + 1) and the samples of their ends."""

    symbols: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    starts_match: np.ndarray
    ends: np.ndarray
    ends_match: np.ndarray
    bounds: np.ndarray


def _packed(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next seven symbols of every position as one number; nothing follows a string's end."""
    n, key = len(text), np.zeros(len(text), np.int64)
    for k in range(_WORD):
        symbol = np.zeros(n, np.int64)
        symbol[:max(n - k, 0)] = text[k:]
        key |= np.where(left > k, symbol, 0) << (_BITS * (_WORD - 1 - k))
    return key


def _order(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling of the compared length."""
    n, length, key = len(words), _WORD, words
    while True:
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.ones(n, bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if fresh.all():
            return order
        if length >= left.max(initial=0):
            return np.argsort(rank * n + np.arange(n))
        after = np.zeros(n, np.int64)
        after[:max(n - length, 0)] = rank[length:]
        key = rank * (n + 1) + np.where(left > length, after, 0)
        length *= 2


def _shared(text: np.ndarray, words: np.ndarray, left: np.ndarray, one: np.ndarray, other: np.ndarray, least: int) -> np.ndarray:
    """The length that each two suffixes share, or 0 where it is less than ``least``."""
    found = np.zeros(len(one), np.int64)
    room = np.minimum(left[one], left[other])
    live = np.flatnonzero(room >= least)
    done = 0
    while len(live):
        fits = room[live] >= done + _WORD
        same = np.zeros(len(live), bool)
        same[fits] = words[one[live[fits]] + done] == words[other[live[fits]] + done]
        # The rest, of fewer than seven equal bytes, byte by byte.
        last = live[~same]
        length = np.full(len(last), done)
        open_ = np.ones(len(last), bool)
        for k in range(done, done + _WORD):
            open_ &= room[last] > k
            at = np.flatnonzero(open_)
            open_[at] = text[one[last[at]] + k] == text[other[last[at]] + k]
            length += open_
        found[last] = length
        live, done = live[same], done + _WORD
    return np.where(found >= least, found, 0)


def build(strings: list[bytes], least: int) -> RunIndex:
    """The index; matches of samples shorter than ``least`` count as 0."""
    sizes = np.array([len(s) for s in strings], np.int64)
    bounds = np.zeros(len(strings) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    text = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    n = len(text)
    left = np.repeat(bounds[1:], sizes) - np.arange(n)
    words = _packed(text, left)
    order = _order(words, left)
    before = np.zeros(n, np.int64)
    before[1:] = text[:-1]
    before[bounds[:-1][sizes > 0]] = 0
    symbol = before[order]
    opens = np.ones(n, bool)
    opens[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], n) - 1 if n else first
    heads, tails = first[first > 0], last[last < n - 1]
    starts, ends = order[first], order[last]
    up, down = np.zeros(len(first), np.int64), np.zeros(len(last), np.int64)
    up[first > 0] = _shared(text, words, left, order[heads], order[heads - 1], least)
    down[last < n - 1] = _shared(text, words, left, order[tails], order[tails + 1], least)
    by_start, by_end = np.argsort(starts), np.argsort(ends)
    return RunIndex(symbol[first], last - first + 1, starts[by_start], up[by_start], ends[by_end], down[by_end], bounds)


def long_matches(index: RunIndex, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, begin and end of every maximal run of bytes inside matches of at least ``least`` bytes."""
    n = int(index.bounds[-1])
    edge = np.zeros(n + 1, np.int64)
    for at, match in ((index.starts, index.starts_match), (index.ends, index.ends_match)):
        # From a sample on the statistic falls by one a byte, up to the next sample.
        until = np.append(at[1:], n)
        long = match >= least
        stop = np.minimum(until[long] - 1, at[long] + match[long] - least) + least
        np.add.at(edge, at[long], 1)
        np.add.at(edge, stop, -1)
    cover = np.zeros(n + 2, bool)
    cover[1:-1] = np.cumsum(edge[:-1]) > 0
    cut = np.zeros(n + 1, bool)
    cut[index.bounds] = True
    begin = np.flatnonzero(cover[1:] & (~cover[:-1] | cut))
    begin = begin[begin < n]
    end = np.flatnonzero(cover[:-1] & (~cover[1:] | cut))
    string = np.searchsorted(index.bounds, begin, "right") - 1
    return string, begin - index.bounds[string], end - index.bounds[string]
