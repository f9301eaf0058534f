"""A compressed full-text index over word ids: backward search over a wavelet matrix, matching statistics.

Suffixes are sorted by their first ``2 ** DOUBLINGS`` words, which is all that searches of at most that many
words need: among the suffixes that begin with a pattern, those preceded by a word keep their order.
"""

from __future__ import annotations

import numpy as np

DOUBLINGS = 6
DEPTH = 1 << DOUBLINGS


class WaveletMatrix:
    """Rank of a symbol in a prefix, from one bit vector per bit of the symbols, packed with block counts."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.n, self.levels = len(symbols), max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        at = symbols
        for level in range(self.levels - 1, -1, -1):
            one = (at >> level) & 1
            packed = np.packbits(one.astype(np.uint8), bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            counts = np.zeros(len(words), np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
            self.counts.append(counts)
            self.zeros.append(int(self.n - one.sum()))
            at = np.concatenate([at[one == 0], at[one == 1]])
        self.first = self._follow(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (words, counts, zeros) in enumerate(zip(self.bits, self.counts, self.zeros, strict=True)):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[word] + np.bitwise_count(words[word] & mask)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1 > 0, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol[i]`` stands before position ``at[i]``."""
        return self._follow(symbol, at) - self.first[symbol]


class FMIndex:
    """Index of ``text`` (ids from 1; 0 is kept for separators, which no pattern holds) for windows of ``window`` words."""

    def __init__(self, text: np.ndarray, n_symbols: int, window: int) -> None:
        if not 1 < window <= DEPTH:
            raise ValueError(f"a window has 2 to {DEPTH} words")
        self.n, self.window = len(text), window
        ranks = [text.astype(np.int64)]
        for d in range(DOUBLINGS):
            behind = np.full(self.n, -1, np.int64)
            step = 1 << d
            if step < self.n:
                behind[: self.n - step] = ranks[-1][step:]
            key = ranks[-1] * (self.n + n_symbols + 2) + behind + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(self.n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
            ranks.append(new)
        self.order = order  # the suffix array, as far as DEPTH words tell
        self.common = self._common(ranks)
        self.tree = WaveletMatrix(np.where(order > 0, text[order - 1], 0), n_symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.narrow = self._groups(window - 1)
        self.full = self._groups(window)
        self._tables: list[np.ndarray] | None = None

    def _common(self, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each suffix with the one before it, in words, DEPTH at most."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        length = np.zeros(len(a), np.int16)
        for d in range(DOUBLINGS - 1, -1, -1):
            for _ in range(2 if d == DOUBLINGS - 1 else 1):
                inside = (a < self.n) & (b < self.n)
                same = inside.copy()
                same[inside] = ranks[d][a[inside]] == ranks[d][b[inside]]
                step = same * (1 << d)
                a, b, length = a + step, b + step, length + step.astype(np.int16)
        return np.concatenate([[0], length])

    def _groups(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the suffix array, start and end of the interval with one prefix of ``depth`` words."""
        starts = np.flatnonzero(self.common < depth)
        number = np.cumsum(self.common < depth) - 1
        ends = np.append(starts[1:], self.n)
        return starts[number], ends[number]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` before them."""
        base = self.smaller[symbol]
        return base + self.tree.rank(symbol, low), base + self.tree.rank(symbol, high)

    def _widened(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``depth`` words of the patterns of [low, high)."""
        if self._tables is None:
            self._tables = [self.common]
            while (1 << len(self._tables)) < self.n:
                last, half = self._tables[-1], 1 << (len(self._tables) - 1)
                self._tables.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last[:0])
        low, high = low.copy(), high.copy()
        for level in range(len(self._tables) - 1, -1, -1):
            table, size = self._tables[level], 1 << level
            if not len(table):
                continue
            # places low - size + 1 ... low all share the prefix with the one before
            can = low - size >= 0
            go = can & (table[np.where(can, low - size + 1, 0).clip(0, len(table) - 1)] >= depth)
            low = np.where(go, low - size, low)
            can = high + size <= self.n
            go = can & (table[np.where(can, high, 0).clip(0, len(table) - 1)] >= depth)
            high = np.where(go, high + size, high)
        return low, high

    def windows(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place of ``words`` at which a window inside its text begins that the index holds, and its interval's start.

        Texts ``words[starts[i]:ends[i]]`` are streamed from their ends, all at once. The state of a text is the
        interval of the longest match that begins at the current word, of ``window`` words at most.
        """
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        length = np.zeros(len(starts), np.int64)
        found_at, found_low = [], []
        at = ends - 1
        while True:
            live = np.flatnonzero(at >= starts)
            if not len(live):
                break
            symbol = words[at[live]]
            known = symbol > 0
            # an unknown word ends every match
            gone = live[~known]
            low[gone], high[gone], length[gone] = 0, self.n, 0
            live, symbol = live[known], symbol[known]
            whole = live[length[live] == self.window]
            low[whole], high[whole] = self.narrow[0][low[whole]], self.narrow[1][low[whole]]
            length[whole] -= 1
            new_low, new_high = self.step(symbol, low[live], high[live])
            failed = new_low >= new_high
            good = live[~failed]
            low[good], high[good], length[good] = new_low[~failed], new_high[~failed], length[good] + 1
            if failed.any():
                self._shorten(live[failed], symbol[failed], low, high, length)
            hit = live[length[live] == self.window]
            found_at.append(at[hit])
            found_low.append(low[hit])
            at = at - 1
        none = np.zeros(0, np.int64)
        return (np.concatenate(found_at), np.concatenate(found_low)) if found_at else (none, none)

    def _shorten(self, which: np.ndarray, symbol: np.ndarray, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> None:
        """The longest shorter match that ``symbol`` can stand before, by bisection over its length."""
        some, none = np.zeros(len(which), np.int64), length[which].copy()  # the whole match fails
        while ((none - some) > 1).any():
            middle = (some + none) // 2
            a, b = self._widened(low[which], high[which], middle)
            a, b = self.step(symbol, a, b)
            works = (a < b) | (middle == 0)
            some, none = np.where(works, middle, some), np.where(works, none, middle)
        a, b = self._widened(low[which], high[which], some)
        a, b = np.where(some == 0, 0, a), np.where(some == 0, self.n, b)
        a, b = self.step(symbol, a, b)
        gone = a >= b  # the word is not in the index at all
        low[which], high[which] = np.where(gone, 0, a), np.where(gone, self.n, b)
        length[which] = np.where(gone, 0, some + 1)
