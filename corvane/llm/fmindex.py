"""A compressed FM-index over word sequences: the Burrows-Wheeler transform in a wavelet matrix of packed bits.

Backward search steps whole arrays of streamed sequences at once. Suffixes are sorted by their first symbols only, as
many as a threshold needs, which leaves every interval of patterns up to that length as it is.
"""

from __future__ import annotations

import numpy as np


class FMIndex:
    """Index of sequences for matches of ``window`` symbols.

    ``symbols``: all sequences, each followed by one 0, which no sequence holds; ``owner``: a number for each symbol,
    of which the least in an interval is asked for.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray, window: int):
        self.window, n = window, len(symbols)
        self.alphabet, text = np.unique(symbols, return_inverse=True)
        ranks, k, rank = {}, 1, text.astype(np.int64)
        order = np.argsort(rank, kind="stable")
        while k <= window:  # to more symbols than the window has
            ranks[k] = rank
            key = rank * n + np.roll(rank, -k)
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]])
            k *= 2
        self.size = n
        bwt = text[order - 1]
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=len(self.alphabet)))][:-1]
        self._pack(bwt)
        self.group, self.group_end = {}, {}
        for length in (window - 1, window):
            same, at, left = np.ones(n - 1, bool), 0, length
            for k in sorted(ranks, reverse=True):
                if left >= k:
                    r = ranks[k][(order + at) % n]
                    same &= r[1:] == r[:-1]
                    at, left = at + k, left - k
            first = np.flatnonzero(np.r_[True, ~same])
            self.group[length], self.group_end[length] = np.cumsum(np.r_[True, ~same]) - 1, np.r_[first, n]
        self.least = np.minimum.reduceat(owner[order], self.group_end[window][:-1])

    def _pack(self, bwt: np.ndarray) -> None:
        self.levels = max(1, int(len(self.alphabet) - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            bits = (row >> level) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.frombuffer(np.pad(packed, (0, 8 - len(packed) % 8 + 8)).tobytes(), np.uint64)
            self.words.append(packed)
            self.ones.append(np.r_[0, np.cumsum(np.bitwise_count(packed))].astype(np.int32))
            self.zeros.append(len(row) - int(bits.sum()))
            row = np.concatenate([row[bits == 0], row[bits == 1]])
        every = np.arange(len(self.alphabet))
        self.base = self._down(every, np.zeros(len(every), np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            ones = self.ones[i][word] + np.bitwise_count(self.words[i][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbol >> level) & 1, self.zeros[i] + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one symbol more in front."""
        shift = self.before[symbol] - self.base[symbol]
        return self._down(symbol, lo) + shift, self._down(symbol, hi) + shift

    def stream(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        """For each sequence (a span of ``symbols``): the starts, from its own on, of windows that a lesser owner has too.

        The matching statistics of a sequence, cut at the window's length: from right to left, each step drops the
        pattern's last symbol once it has the full length (the interval of all suffixes with the same first symbols,
        one fewer) and puts the next symbol in front.
        """
        at = np.searchsorted(self.alphabet, symbols)
        known = np.minimum(at, len(self.alphabet) - 1)
        missing, symbol = self.alphabet[known] != symbols, known
        order = np.argsort(start - end, kind="stable")
        s, e, own = start[order], end[order], owner[order]
        size, w = e - s, self.window
        lo, hi, length = np.zeros(len(s), np.int64), np.full(len(s), self.size, np.int64), np.zeros(len(s), np.int64)
        found_row, found_at = [], []
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, "left"))
            p = e[:live] - 1 - t
            l, h, n = lo[:live], hi[:live], length[:live]
            full = np.flatnonzero(n == w)
            if len(full):
                g = self.group[w - 1][l[full]]
                l[full], h[full], n[full] = self.group_end[w - 1][g], self.group_end[w - 1][g + 1], w - 1
            l[:], h[:] = self.step(symbol[p], l, h)
            n += 1
            none = (l >= h) | missing[p]  # not in the index: begin anew in front of it
            l[none], h[none], n[none] = 0, self.size, 0
            full = np.flatnonzero(n == w)
            hit = full[self.least[self.group[w][l[full]]] < own[full]]
            found_row.append(hit)
            found_at.append(p[hit] - s[hit])
        rows, ats = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_row, found_at))
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(s)
        by = np.lexsort((ats, rows))
        rows, ats = rows[by], ats[by]
        for r, part in zip(np.unique(rows), np.split(ats, np.flatnonzero(np.diff(rows)) + 1), strict=False):
            out[order[r]] = part
        return out
