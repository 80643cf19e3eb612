"""A compressed FM-index in numpy: suffix order by prefix doubling, a wavelet matrix over the BWT, batched backward search."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector packed into 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.append(bits, np.zeros(64 + (-n) % 64, bool)).astype(np.uint8), bitorder="little").view(np.uint64)
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)))[:-1].astype(np.int32)
        self.zeros = n - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits."""
        w = at >> 6
        low = self.words[w] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low)


class FMIndex:
    """Index of a text of symbols 1..sigma-1 in which 0 parts the sequences; patterns hold at most `depth` symbols, none 0."""

    def __init__(self, text: np.ndarray, depth: int):
        text = np.append(text, 0).astype(np.int64)
        self.n, self.sigma = len(text), int(text.max()) + 1
        order = self._suffixes(text, depth)
        bwt = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=self.sigma))))
        self.levels, start, v = [], np.zeros(self.sigma, np.int64), bwt
        symbols = np.arange(self.sigma)
        for shift in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            bit = (v >> shift) & 1
            b = Bits(bit.astype(bool))
            start = np.where((symbols >> shift) & 1, b.zeros + b.ones(start), start - b.ones(start))
            self.levels.append((shift, b))
            v = np.concatenate((v[bit == 0], v[bit == 1]))
        self.start = start

    @staticmethod
    def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffix order by their first `depth` symbols at least (ties by place)."""
        rank, k, n = np.unique(text, return_inverse=True)[1].astype(np.int64), 1, len(text)
        order = np.argsort(rank, kind="stable")
        while k < depth:
            key = rank * (n + 1)
            key[: n - k] += rank[k:] + 1
            order = np.argsort(key, kind="stable")
            s = key[order]
            rank[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
            if rank[order[-1]] == n - 1:
                break
            k *= 2
        return order

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of c among the first `at` symbols of the BWT."""
        for shift, b in self.levels:
            ones = b.ones(at)
            at = np.where((c >> shift) & 1, b.zeros + ones, at - ones)
        return at - self.start[c]

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of cP for those of P."""
        both = self.rank(np.concatenate((c, c)), np.concatenate((lo, hi)))
        return self.first[c] + both[: len(c)], self.first[c] + both[len(c) :]

    def matching(self, pattern: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> np.ndarray:
        """Matching statistics: for each end (exclusive) in a pattern parted by 0s, the length, up to `most`, of the longest
        piece that ends there and occurs `least` times or more in the text."""
        length = np.zeros(len(ends), np.int64)
        live, lo, hi = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        for k in range(most):
            at = ends[live] - k - 1
            c = np.where(at >= 0, pattern[np.maximum(at, 0)], 0)
            ok = (c > 0) & (c < self.sigma)
            live, lo, hi, c = live[ok], lo[ok], hi[ok], c[ok]
            lo, hi = self.step(c, lo, hi)
            ok = hi - lo >= least
            live, lo, hi = live[ok], lo[ok], hi[ok]
            length[live] = k + 1
            if not len(live):
                break
        return length
