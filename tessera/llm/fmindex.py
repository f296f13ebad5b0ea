"""FM-index over integer symbols: suffix order, wavelet matrix with packed ranks, batched backward
search and location by sampled suffix positions. All steps work on whole arrays of queries."""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffixes of ``seq`` in order, by prefix doubling, and the ranks by prefix length.

    Compares ``depth`` symbols at least (None: whole suffixes, which then all differ as the end of
    the sequence counts as least). ``ranks[k][i]`` numbers the first k symbols from i in order.
    """
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    k, ranks = 1, {1: rank}
    order = np.argsort(rank, kind="stable")
    while (k < depth if depth else True):
        after = np.zeros(n, np.int64)
        after[:max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))[:n]
        k *= 2
        ranks[k] = rank
        if not depth and (not n or rank[order[-1]] == n - 1):
            break
    return order, ranks


class WaveletMatrix:
    """Ranks over a sequence of symbols in one packed bit row per symbol bit."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        n = len(seq)
        self.n, self.levels = n, max(1, int(n_symbols - 1).bit_length())
        words = n // 64 + 1
        self.bits = np.zeros((self.levels, words), np.uint64)
        self.before = np.zeros((self.levels, words), np.int32)
        self.zeros = np.zeros(self.levels, np.int64)
        seq = seq.astype(np.int32)
        for j in range(self.levels):
            bit = ((seq >> (self.levels - 1 - j)) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            row = np.zeros(words * 8, np.uint8)
            row[:len(packed)] = packed
            self.bits[j] = row.view(np.uint64)
            self.before[j, 1:] = np.cumsum(np.bitwise_count(self.bits[j, :-1]))
            self.zeros[j] = n - int(bit.sum())
            seq = np.concatenate((seq[~bit], seq[bit]))
        symbols = np.arange(n_symbols)
        self.first = self._descend(symbols, np.zeros(n_symbols, np.int64))

    def _ones(self, j: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[j, w] + np.bitwise_count(self.bits[j, w] & low)

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for j in range(self.levels):
            ones = self._ones(j, i)
            i = np.where((c >> (self.levels - 1 - j)) & 1, self.zeros[j] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs before position ``i``."""
        return self._descend(c, i) - self.first[c]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its rank there."""
        c = np.zeros(len(i), np.int64)
        for j in range(self.levels):
            ones = self._ones(j, i)
            bit = (self.bits[j, i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            c = 2 * c + bit.astype(np.int64)
            i = np.where(bit, self.zeros[j] + ones, i - ones)
        return c, i - self.first[c]


class FMIndex:
    """Backward search over a sequence of symbols ``0..n_symbols-1``.

    With ``depth`` the rows are ordered by that many symbols only: searches up to that length are
    exact, ``locate`` is not available. ``sample`` keeps every so many suffix positions.
    """

    def __init__(self, seq: np.ndarray, n_symbols: int, depth: int | None = None, sample: int = 8):
        n = len(seq)
        order, self.ranks = suffix_order(seq, depth)
        self.n = n
        # a row for the empty suffix comes first; its preceding symbol is the last one
        before = np.concatenate(([n - 1], order - 1)) if n else np.zeros(0, np.int64)
        bwt = np.where(before >= 0, seq[before], n_symbols) if n else np.array([n_symbols])
        self.wavelet = WaveletMatrix(bwt, n_symbols + 1)  # the extra symbol stands before the start
        counts = np.bincount(seq, minlength=n_symbols) if n else np.zeros(n_symbols, np.int64)
        self.below = np.concatenate(([1], 1 + np.cumsum(counts)))
        self.order = order if depth else None
        if not depth:
            positions = np.concatenate(([n], order))
            keep = positions % sample == 0
            self.kept = WaveletMatrix(keep.astype(np.int64), 2)
            self.samples = positions[keep].astype(np.int64)

    def extend(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of ``c`` followed by the patterns of ``[low, high)``."""
        both = self.wavelet.rank(np.concatenate((c, c)), np.concatenate((low, high)))
        return self.below[c] + both[:len(c)], self.below[c] + both[len(c):]

    def search(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of the patterns ``flat[start:start+length]``, all searched together."""
        low, high = np.zeros(len(start), np.int64), np.full(len(start), self.n + 1)
        live = np.arange(len(start))
        for k in range(int(length.max(initial=0))):
            live = live[(length[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            c = flat[start[live] + length[live] - 1 - k]
            low[live], high[live] = self.extend(c, low[live], high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled suffix."""
        at, steps = np.asarray(rows, np.int64).copy(), np.zeros(len(rows), np.int64)
        out = np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            kept, rank = self.kept.access_rank(at[live])
            hit = live[kept == 1]
            out[hit] = self.samples[rank[kept == 1]] + steps[hit]
            live = live[kept == 0]
            c, r = self.wavelet.access_rank(at[live])
            at[live] = self.below[c] + r
            steps[live] += 1
        return out
