"""Elias-Fano coded monotone numbers and a two-level n-gram trie of them.

A level is a flat run of bytes: it can be written, mapped into memory and read in place, and all
reads go to the coded form.
"""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)
_SIX = np.uint64(6)
_LOW6 = np.uint64(63)


def _select(bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Of every word the place of the bit with ``left`` ones below it, by halving the word."""
    at = np.zeros(len(bits), dtype=np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        mask = np.uint64((1 << step) - 1)
        count = np.bitwise_count((bits >> at) & mask).astype(np.uint64)
        beyond = left >= count
        left = left - count * beyond
        at = at + np.uint64(step) * beyond
    return at


@dataclass(frozen=True)
class EliasFano:
    """Non-decreasing numbers: low bits packed, high bits as one bit per number after one zero bit
    per step, and the count of ones before every word of them."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
        low = np.zeros(n * width // 64 + 2, dtype=np.uint64)
        if width:
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            part = values & np.uint64((1 << width) - 1)
            word, shift = (at >> _SIX).astype(np.int64), at & _LOW6
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(width) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        size = int(place[-1]) // 64 + 1 if n else 1
        high = np.zeros(size, dtype=np.uint64)
        np.bitwise_or.at(high, (place >> _SIX).astype(np.int64), _ONE << (place & _LOW6))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        return EliasFano(n, width, low, high, ones)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        word = np.searchsorted(self.ones, index, side="right") - 1
        left = (index - self.ones[word]).astype(np.uint64)
        at = _select(self.high[word], left)
        out = (word.astype(np.uint64) << _SIX) + at - index.astype(np.uint64)
        if not self.width:
            return out
        start = index.astype(np.uint64) * np.uint64(self.width)
        word, shift = (start >> _SIX).astype(np.int64), start & _LOW6
        low = self.low[word] >> shift
        low |= np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & _LOW6), np.uint64(0))
        return out << np.uint64(self.width) | low & np.uint64((1 << self.width) - 1)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have smaller high bits: the ones before the zero that ends the step below."""
        zeros = (np.arange(len(self.ones), dtype=np.int64) << 6) - self.ones
        out = np.where(high > 0, self.n, 0)
        some = np.flatnonzero((high > 0) & (high <= zeros[-1]))
        k = high[some] - 1
        word = np.searchsorted(zeros, k, side="right") - 1
        at = _select(~self.high[word], (k - zeros[word]).astype(np.uint64))
        out[some] = (word << 6) + at.astype(np.int64) - k
        return out

    def first_not_less(self, wanted: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Successor search: the first place in [start, end) whose number is not less, or end.

        Only numbers with the high bits of the wanted one are compared."""
        high = np.minimum(wanted >> np.uint64(self.width), np.uint64(1 << 62)).astype(np.int64)
        low, above = (np.clip(self._below(x), start, end) for x in (high, high + 1))
        start, end = low, above
        active = np.flatnonzero(start < end)
        while len(active):
            middle = (start[active] + end[active]) >> 1
            less = self.access(middle) < wanted[active]
            start[active[less]] = middle[less] + 1
            end[active[~less]] = middle[~less]
            active = active[start[active] < end[active]]
        return start

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.width, len(self.low), len(self.high)], dtype="<i8")
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.ones))

    @staticmethod
    def view(data: memoryview) -> tuple[EliasFano, int]:
        """The numbers coded at the start of a buffer, read in place, and where they end."""
        n, width, low, high = np.frombuffer(data, "<i8", 4).tolist()
        parts, at = [], 32
        for kind, size in (("<u8", low), ("<u8", high), ("<i8", high + 1)):
            parts.append(np.frombuffer(data, kind, size, at))
            at += 8 * size
        return EliasFano(n, width, *parts), at


#: Levels of a probability, decimal logarithms from LOWEST up in steps; the last is 0.
LEVELS = 1 << 16
LOWEST = -16.0
STEP = -LOWEST / (LEVELS - 1)


class Trie:
    """Words, the pointers to their ranges of contexts, the contexts within each range, and two bytes
    for the probability of each pair: the same levels in every trie, so that a pair's probability
    does not depend on the pairs it is held with.

    Contexts are numbers below ``contexts``; they are coded relative to their word's range.
    """

    def __init__(self, data: memoryview):
        self.contexts, self.lowest, self.step = np.frombuffer(data, "<f8", 3).tolist()
        at = 24
        levels = []
        for _ in range(3):
            level, size = EliasFano.view(data[at:])
            levels.append(level)
            at += size
        self.words, self.pointers, self.pairs = levels
        self.codes = np.frombuffer(data, "<u2", self.pairs.n, at)

    @staticmethod
    def build(words: np.ndarray, first: np.ndarray, context: np.ndarray, log_p: np.ndarray, contexts: int) -> bytes:
        """From ascending words, the place of each word's first pair (and the number of pairs), and
        the ascending contexts and log probabilities of the pairs of each word."""
        rank = np.repeat(np.arange(len(words), dtype=np.uint64), np.diff(first))
        codes = np.clip(np.rint((log_p - LOWEST) / STEP), 0, LEVELS - 1).astype("<u2")
        levels = (words, first, rank * np.uint64(contexts) + context.astype(np.uint64))
        head = np.array([contexts, LOWEST, STEP], dtype="<f8").tobytes()
        return b"".join([head, *(EliasFano.encode(x).to_bytes() for x in levels), codes.tobytes()])

    @staticmethod
    def mapped(data: bytes) -> Trie:
        """The trie in a memory map of its own."""
        area = mmap.mmap(-1, max(len(data), 1))
        area.write(data)
        return Trie(memoryview(area))

    def find_words(self, words: np.ndarray) -> np.ndarray:
        """Rank of each word, or -1."""
        n = self.words.n
        if n == 0:
            return np.full(len(words), -1, dtype=np.int64)
        at = self.words.first_not_less(words, np.zeros(len(words), np.int64), np.full(len(words), n, np.int64))
        hit = at < n
        hit[hit] = self.words.access(at[hit]) == words[hit]
        return np.where(hit, at, -1)

    def log_p(self, rank: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Log probability of pairs of the word ``rank[word]`` and a context, nan where it is not
        held."""
        known = np.maximum(rank, 0)
        start = self.pointers.access(known).astype(np.int64) if self.pointers.n else known
        end = self.pointers.access(known + 1).astype(np.int64) if self.pointers.n else known
        end = np.where(rank >= 0, end, start)
        wanted = known[word].astype(np.uint64) * np.uint64(int(self.contexts)) + context.astype(np.uint64)
        at = self.pairs.first_not_less(wanted, start[word], end[word])
        hit = at < end[word]
        hit[hit] = self.pairs.access(at[hit]) == wanted[hit]
        out = np.full(len(word), np.nan)
        out[hit] = self.lowest + self.step * self.codes[at[hit]]
        return out
