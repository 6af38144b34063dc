"""An FM-index over sequences of words, in numpy.

The words of a shard's texts are numbered, the texts joined by a separator. The suffix array is
sorted by prefix doubling in which only suffixes that are not yet told apart are sorted again. Of
it remain the Burrows-Wheeler transform, in a wavelet matrix with rank support, and every SAMPLE-th
text position. Searches go backward through the ranks, for many phrases at once; occurrences are
located by stepping to the nearest sampled suffix.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

#: Distance of the sampled suffix positions.
SAMPLE = 16
#: Symbols before the words: the end of the shard and the end of a text.
END, SEPARATOR, FIRST_WORD = 0, 1, 2


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8)])
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        word, low = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Symbols with rank and access in as many steps as they have bits."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[int, Bits, int]] = []
        left = symbols
        for shift in range(self.depth - 1, -1, -1):
            bit = ((left >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(bit), int(len(bit) - np.count_nonzero(bit))))
            left = np.concatenate([left[~bit], left[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before place i."""
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i and its rank there."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for _, bits, zeros in self.levels:
            one = bits.at(i)
            a, b = bits.ones(start), bits.ones(i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
            symbol = symbol * 2 + one
        return symbol, i - start


def suffix_array(text: np.ndarray, sigma: int) -> np.ndarray:
    """Starts of the suffixes in order; the last symbol is END and occurs once."""
    n = len(text)
    t = text.astype(np.int64)
    # as many symbols as fit into 62 bits are compared at once
    bits = max(1, int(sigma - 1).bit_length())
    h = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(h):
        key <<= bits
        if j < n:
            key[: n - j] |= t[j:]
    sa = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    active, key = np.arange(n), key[sa]
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        rank[sa[active]] = np.repeat(active[first], size)
        active = active[np.repeat(size > 1, size)]
        if not len(active):
            return sa
        at = sa[active]
        key = rank[at] * np.int64(n + 1) + np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        order = np.argsort(key)
        sa[active], key = at[order], key[order]
        h *= 2


class FMIndex:
    """Over texts given as lists of words. Not thread-safe while it is built, read-only after."""

    def __init__(self, texts: list[list[str]]):
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = lambda: len(self.number) + FIRST_WORD
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        #: place of each text's first word
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        t = np.full(int(lengths.sum()) + len(texts) + 1, SEPARATOR, dtype=np.int64)
        t[-1] = END
        number = self.number.__getitem__
        for start, words in zip(self.starts.tolist(), texts):
            t[start : start + len(words)] = np.fromiter(map(number, words), dtype=np.int64, count=len(words))
        self.number.default_factory = None
        sigma = len(self.number) + FIRST_WORD
        sa = suffix_array(t, sigma)
        self.n = len(t)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma))])
        self.bwt = WaveletMatrix(t[sa - 1], sigma)
        sampled = sa % SAMPLE == 0
        self.sampled, self.positions = Bits(sampled), sa[sampled]

    def numbers(self, words: list[str]) -> list[int]:
        """The words' numbers; -1 for one that no text has."""
        return [self.number.get(w, -1) for w in words]

    def _step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.bwt.rank(symbol, i)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows lo..hi-1 of the suffixes that begin with each phrase, a row of word numbers."""
        m, k = phrases.shape
        lo, hi = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
        left = np.flatnonzero((phrases >= FIRST_WORD).all(axis=1))
        a, b = np.zeros(len(left), dtype=np.int64), np.full(len(left), self.n, dtype=np.int64)
        for j in range(k - 1, -1, -1):
            c = phrases[left, j]
            a, b = self._step(c, a), self._step(c, b)
            some = a < b
            left, a, b = left[some], a[some], b[some]
        lo[left], hi[left] = a, b
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        out = np.empty(len(rows), dtype=np.int64)
        todo, i, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.sampled.at(i)
            out[todo[hit]] = self.positions[self.sampled.ones(i[hit])] + steps
            todo, i = todo[~hit], i[~hit]
            if len(todo):
                symbol, rank = self.bwt.access(i)
                i = self.before[symbol] + rank
            steps += 1
        return out

    def occurrences(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, text, word offset in the text) of every occurrence of every phrase."""
        lo, hi = self.search(phrases)
        n = hi - lo
        phrase = np.repeat(np.arange(len(phrases)), n)
        rows = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = self.locate(rows)
        text = np.searchsorted(self.starts, at, side="right") - 1
        return phrase, text, at - self.starts[text]
