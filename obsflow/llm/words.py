"""Vectorised words, word hashes and shingles of a batch of texts (numpy over the UTF-8 bytes)."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
#: Random 64-bit value per byte and an odd random base: a word's hash is sum(value[byte_i] * base^i) mod 2^64.
_VALUE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_CHUNK = 1 << 18


def fold_ascii(values: np.ndarray) -> np.ndarray:
    """The table with A-Z mapped like a-z."""
    out = values.copy()
    out[65:91] = out[97:123]
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Fixed value: bytes that separate words: the six ASCII blanks.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
#: Fixed value: bytes of alphanumeric words: digits, ASCII letters and everything beyond ASCII.
ALNUM = np.ones(256, dtype=bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x41] = ALNUM[0x5B:0x61] = ALNUM[0x7B:0x80] = False

VALUE_FOLDED = fold_ascii(_VALUE)


def find_words(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per text) of the maximal runs of ``word_byte`` bytes; runs never cross texts."""
    n = len(off) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    w = word_byte[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    full = off[1:] > off[:-1]
    a, b = off[:-1][full], off[1:][full] - 1
    first[a] = w[a]
    last[b] = w[b]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.diff(np.searchsorted(start, off))


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = VALUE_FOLDED) -> np.ndarray:
    """64-bit hash of every word; work arrays are bounded by a chunk or the longest word."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    power = inverse = np.zeros(0, np.uint64)
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _CHUNK, "right")))
        a, b = int(start[i]), int(end[j - 1])
        if b - a > len(power):
            power, inverse = _powers(_BASE, max(_CHUNK, b - a)), _powers(_INVERSE, max(_CHUNK, b - a))
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(value[data[a:b]] * power[:b - a], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix64(out)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int, value: np.ndarray = VALUE_FOLDED,
                 word_byte: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): per text its distinct ``k``-word shingles as sorted 64-bit hashes.

    Fewer than ``k`` words make one shingle of the whole sequence; no words, none.
    """
    start, end, per = find_words(data, off, word_byte)
    h = hash_words(data, start, end, value)
    woff = np.concatenate([[0], np.cumsum(per)])
    weights = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n_sh = np.where(per >= k, per - k + 1, (per > 0).astype(np.int64))
    soff = np.concatenate([[0], np.cumsum(n_sh)])
    roll = np.zeros(len(h), dtype=np.uint64)
    for j in range(k):
        m = len(h) - j
        if m > 0:
            roll[:m] += mix64(h[j:] ^ weights[j]) * weights[j]
    sh = np.empty(soff[-1], dtype=np.uint64)
    long = per >= k
    text_of = np.repeat(np.arange(len(per)), n_sh)
    pos = woff[:-1][text_of] + np.arange(len(sh)) - soff[:-1][text_of]
    sh[:] = roll[pos] if len(sh) else 0
    for t in np.flatnonzero((per > 0) & ~long):
        acc = per[t:t + 1].astype(np.uint64)
        for x in h[woff[t]:woff[t + 1]]:
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + x)
        sh[soff[t]] = acc[0]
    sh = mix64(sh)
    for t in np.flatnonzero(n_sh > 1):
        sh[soff[t]:soff[t + 1]].sort()
    keep = np.ones(len(sh), dtype=bool)
    keep[1:] = sh[1:] != sh[:-1]
    keep[soff[:-1][n_sh > 0]] = True
    counts = np.diff(np.concatenate([[0], np.cumsum(keep)])[soff])
    return sh[keep], np.concatenate([[0], np.cumsum(counts)])
