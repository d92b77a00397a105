"""An FM-index over whole numbers: suffix array, wavelet tree ranks, sampled positions; all searches run side by side."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling; a shorter suffix comes before those it begins."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.zeros(n, dtype=np.int64)
    rank[order[1:]] = np.cumsum(text[order[1:]] != text[order[:-1]])
    k = 1
    while n and rank[order[-1]] < n - 1:
        second = np.zeros(n, dtype=np.int64)
        second[: max(n - k, 0)] = rank[k:] + 1
        both = rank * (n + 1) + second
        order = np.argsort(both, kind="stable")
        rank = np.zeros(n, dtype=np.int64)
        rank[order[1:]] = np.cumsum(both[order[1:]] != both[order[:-1]])
        k *= 2
    return order


class WaveletTree:
    """Ranks of a symbol in a sequence, by one bit vector with running counts for each bit of the symbols (wavelet matrix)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for b in range(bits - 1, -1, -1):
            ones = (values >> b) & 1
            counts = np.zeros(len(values) + 1, dtype=np.int64)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((counts, len(values) - int(counts[-1])))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its end, for arrays of both."""
        start, end = np.zeros_like(ends), ends
        for i, (counts, zeros) in enumerate(self.levels):
            one = (symbols >> (self.bits - 1 - i)) & 1 == 1
            start = np.where(one, zeros + counts[start], start - counts[start])
            end = np.where(one, zeros + counts[end], end - counts[end])
        return end - start

    def at(self, places: np.ndarray) -> np.ndarray:
        """The symbols at some places."""
        out = np.zeros_like(places)
        for counts, zeros in self.levels:
            one = counts[places + 1] - counts[places]
            out = out * 2 + one
            places = np.where(one == 1, zeros + counts[places], places - counts[places])
        return out


class FMIndex:
    """An index over text, whose symbols are 1 and more; 0 is taken for its end."""

    def __init__(self, text: np.ndarray, alphabet: int, every: int = 8):
        text = np.append(np.asarray(text, dtype=np.int64), 0)
        order = suffix_array(text)
        last = text[order - 1]
        self.size, self.every = len(text), every
        self.before = np.zeros(alphabet + 2, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=alphabet + 1), out=self.before[1:])
        self.tree = WaveletTree(last, max(1, int(alphabet).bit_length()))
        sampled = order % every == 0
        self.sampled = np.zeros(len(text) + 1, dtype=np.int64)
        np.cumsum(sampled, out=self.sampled[1:])
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges [low, high) of phrases, one a row, all of one length; backward, one symbol of all phrases at a time."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, j]
            low[alive] = self.before[c] + self.tree.rank(c, low[alive])
            high[alive] = self.before[c] + self.tree.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        high = np.maximum(high, low)
        dead = np.ones(len(phrases), dtype=bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking back to the nearest sampled one."""
        rows, out = rows.copy(), np.full(len(rows), -1, dtype=np.int64)
        walking = np.arange(len(rows))
        for steps in range(self.every + 1):
            at = rows[walking]
            known = self.sampled[at + 1] > self.sampled[at]
            out[walking[known]] = self.positions[self.sampled[at[known]]] + steps
            walking, at = walking[~known], at[~known]
            if not len(walking):
                break
            c = self.tree.at(at)
            rows[walking] = self.before[c] + self.tree.rank(c, at)
        return out
