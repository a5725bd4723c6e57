"""An FM-index over one shard of word symbols, in numpy.

The text is a sequence of symbols in which 0 separates runs; patterns hold no 0.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every separator is smaller than all
    symbols and differs from every other separator, so runs never tie for long."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    cut = symbols == 0
    rank = np.where(cut, np.cumsum(cut) - 1, symbols.astype(np.int64) + int(cut.sum()))
    order = np.argsort(rank, kind="stable")
    length = 0
    while True:
        ordered = rank[order] if not length else key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        length = 2 * length or 1
        later = np.full(n, -1, np.int64)
        later[: max(0, n - length)] = rank[length:]
        key = rank * (n + 1) + later + 1
        order = np.argsort(key, kind="stable")


class WaveletRanks:
    """How often a symbol occurs before a place, by one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros, level = [], [], symbols.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(place), place
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1 == 1
            low_1, high_1 = ones[low], ones[high]
            low = np.where(bit, zeros + low_1, low - low_1)
            high = np.where(bit, zeros + high_1, high - high_1)
        return high - low

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[place + 1] - ones[place]
            symbol = symbol * 2 + bit
            place = np.where(bit == 1, zeros + ones[place], place - ones[place])
        return symbol


class FMIndex:
    def __init__(self, symbols: np.ndarray):
        n, top = len(symbols), int(symbols.max(initial=0))
        order = suffix_order(symbols)
        self.n, self.top = n, top
        before = symbols[order - 1]  # of the suffix at 0: the last symbol, which is never reached
        before = np.where(order == 0, 0, before)
        self.ranks = WaveletRanks(before, top)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))]).astype(np.int64)
        # a suffix at a run's start is sampled too, so no walk crosses a separator
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all patterns (rows, left-aligned) at once, from their last symbols backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(patterns.shape[1] if len(patterns) else 0):
            at = lengths - 1 - back
            live = np.flatnonzero((at >= 0) & (low < high))
            symbol = patterns[live, at[live]].astype(np.int64)
            known = symbol <= self.top
            symbol = np.where(known, symbol, 0)
            base = self.smaller[symbol]
            low[live] = np.where(known, base + self.ranks.rank(symbol, low[live]), 0)
            high[live] = np.where(known, base + self.ranks.rank(symbol, high[live]), 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks: walk back to a sampled suffix."""
        place, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = place[open_]
            done = self.sampled[at]
            out[open_[done]] = self.samples[self.sample_rank[at[done]]] + steps[open_[done]]
            open_, at = open_[~done], at[~done]
            symbol = self.ranks.access(at)
            place[open_] = self.smaller[symbol] + self.ranks.rank(symbol, at)
            steps[open_] += 1
        return out
