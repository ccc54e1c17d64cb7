"""An FM-index over a sequence of small numbers: wavelet-tree ranks, sampled suffix places."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length of the prefix that is ranked."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if step >= n or new[-1] == n - 1:
            return order


class WaveletTree:
    """Level-wise wavelet tree (a wavelet matrix): one bit row for each bit of the symbols."""

    def __init__(self, seq: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(bits - 1, -1, -1):
            row = (seq >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(row)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[row == 0], seq[row == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before place ``at``."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at a place, and how often it occurs before."""
        low, place, symbol = np.zeros(len(at), np.int64), at.astype(np.int64), np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[place + 1] > ones[place]
            symbol = symbol * 2 + one
            low = np.where(one, zeros + ones[low], low - ones[low])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return symbol, place - low


class FMIndex:
    """Symbols are numbers from 0; the sequence ends in its only 0, which no pattern holds."""

    def __init__(self, seq: np.ndarray, n_symbols: int, sample: int = 8) -> None:
        order = suffix_array(seq)
        self.sample = sample
        last = seq[order - 1]
        self.tree = WaveletTree(last, max(1, int(n_symbols - 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=n_symbols))])
        self.sampled = order % sample == 0
        self.n_sampled = np.concatenate([[0], np.cumsum(self.sampled)])
        self.places = order[self.sampled]

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern: a row, read from its end, padded in front."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.before[-1], np.int64)
        width = patterns.shape[1]
        for k in range(width):
            on = np.flatnonzero((k < sizes) & (low < high))
            if not len(on):
                break
            symbol = patterns[on, width - 1 - k]
            low[on] = self.before[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.before[symbol] + self.tree.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes: step back through the text until a sampled one is met."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(on := np.flatnonzero(~self.sampled[rows])):
            symbol, rank = self.tree.access_rank(rows[on])
            rows[on] = self.before[symbol] + rank
            steps[on] += 1
        return self.places[self.n_sampled[rows]] + steps
