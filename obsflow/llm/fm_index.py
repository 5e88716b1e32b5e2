"""An FM-index over one shard of word ids: wavelet-matrix ranks, backward search, sampled locate."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Positions in suffix order. Symbol 0 separates: every 0 differs from every other 0 (earlier sorts first).

    Prefix doubling on the suffixes whose rank is still shared; a rank is the
    first place of its group, so settled suffixes are never touched again.
    """
    n = len(sym)
    key = sym.astype(np.int64) + n
    zeros = np.flatnonzero(sym == 0)
    key[zeros] = np.arange(len(zeros))
    active, step = np.arange(n), 0
    rank = np.zeros(n, dtype=np.int64)
    while len(active):
        if step:
            nxt = active + step
            follow = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
            key = rank[active] * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        i = np.arange(len(active))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        first_key = np.maximum.accumulate(np.where(new_key, i, 0))
        first_group = np.maximum.accumulate(np.where(new_group, i, 0))
        rank[active] = group + first_key - first_group
        alone = new_key & np.concatenate([new_key[1:], [True]])
        active = active[~alone]
        step = max(1, step * 2)
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


class Bits:
    """A bit vector with constant-time rank: 64-bit words and the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros(-(-(self.n + 1) // 64) * 64, dtype=np.uint8)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = self.n - int(ones.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Over ``sym`` (0 separates runs; other symbols below ``sigma``)."""

    def __init__(self, sym: np.ndarray, sigma: int):
        sa = suffix_array(sym)
        bwt = np.where(sa > 0, sym[sa - 1], 0)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sym, minlength=sigma))])
        self.levels = []
        self.bits = max(1, int(sigma - 1).bit_length())
        for level in range(self.bits - 1, -1, -1):
            b = (bwt >> level) & 1
            self.levels.append((level, Bits(b)))
            bwt = np.concatenate([bwt[b == 0], bwt[b == 1]])
        # sampled suffix positions: starts of runs and every 16th position, so no walk crosses a separator
        run_start = np.concatenate([[True], sym[:-1] == 0]) if len(sym) else np.zeros(0, bool)
        mark = run_start[sa] | (sa % SAMPLE == 0)
        self.marked = Bits(mark)
        self.sampled = sa[mark]

    def _rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Number of ``c`` in the first ``i`` places of the transformed text."""
        start = np.zeros_like(i)
        for level, b in self.levels:
            one = (c >> level) & 1 == 1
            r_i, r_s = b.rank1(i), b.rank1(start)
            i = np.where(one, b.zeros + r_i, i - r_i)
            start = np.where(one, b.zeros + r_s, start - r_s)
        return i - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, lo, hi) of the phrases (rows of equal length) that occur, by backward search."""
        which = np.arange(len(phrases))
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.first[-1], dtype=np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[which, j]
            lo, hi = self.first[c] + self._rank(c, lo), self.first[c] + self._rank(c, hi)
            alive = hi > lo
            which, lo, hi = which[alive], lo[alive], hi[alive]
            if not len(which):
                break
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a sampled row, adding the steps."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.marked.get(at)
            out[todo[hit]] = self.sampled[self.marked.rank1(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            i, c, start = at, np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
            for level, b in self.levels:
                one = b.get(i)
                c |= one.astype(np.int64) << level
                r_i, r_s = b.rank1(i), b.rank1(start)
                i = np.where(one, b.zeros + r_i, i - r_i)
                start = np.where(one, b.zeros + r_s, start - r_s)
            at = self.first[c] + i - start
            steps += 1
        return out
