"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits the features in turn and adds a shallow tree of one
feature to that feature's lookup table, then does the same for the strongest
pairs on a coarser grid. Scoring adds one table entry per feature and pair.

Rules: null text is empty; every row of the documents gets a score; labels
other than 0 and 1 and rows without a label teach nothing; without both classes
the score is the (smoothed) share of ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import stash, text_slices, utf8
from obsflow.llm.words import NOT_BLANK, find_words, hash_words

FEATURES = ["log_bytes", "log_words", "word_bytes", "longest_word", "short_words", "upper", "digits", "beyond_ascii",
            "blanks", "pipes", "marks", "stops", "commas", "brackets", "other_symbols", "distinct_words", "top_word",
            "repeats", "log_lines", "distinct_lines", "words_a_line", "symbol_ends", "caps_words"]
#: Labelled rows a model is fitted on at most (those with the smallest hash of their id).
FIT_ROWS = 50_000

_BYTE_KIND = np.full(256, 10, dtype=np.int64)
for kind, members in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789",
                                " \t\n\x0b\x0c\r", "|", "!?", ".", ",;:'\"-", "()[]{}<>/\\="]):
    for ch in members:
        _BYTE_KIND[ord(ch)] = kind
_BYTE_KIND[128:] = 9
_KINDS = 11
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[10] = False


def _distinct_and_top(h: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes and the count of the most frequent one."""
    distinct, top = np.zeros(len(per)), np.zeros(len(per))
    off = np.concatenate([[0], np.cumsum(per)])
    for t in np.flatnonzero(per):
        s = np.sort(h[off[t]:off[t + 1]])
        edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
        distinct[t], top[t] = len(edge) - 1, np.diff(edge).max()
    return distinct, top


def text_features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(off) - 1
    size = np.diff(off)
    kinds = np.bincount(np.repeat(np.arange(n), size) * _KINDS + _BYTE_KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    upper, lower, digit, blank, pipe, mark, stop, comma, bracket, beyond, other = kinds.T
    start, end, words = find_words(data, off, NOT_BLANK)
    h = hash_words(data, start, end)
    text = np.repeat(np.arange(n), words)
    length = end - start
    per = np.maximum(words, 1)
    distinct, top = _distinct_and_top(h, words)
    same = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    share = lambda flag: np.bincount(text[flag], minlength=n) / per
    last_kind, first_kind = (_BYTE_KIND[data[end - 1]], _BYTE_KIND[data[start]]) if len(start) else (text, text)
    l_start, l_end, lines = find_words(data, off, _NOT_NEWLINE)
    l_distinct, _ = _distinct_and_top(hash_words(data, l_start, l_end), lines)
    bytes_ = np.maximum(size, 1)
    return np.stack([
        np.log1p(size), np.log1p(words), np.bincount(text, length, n) / per, np.log1p(longest), share(length == 1),
        upper / np.maximum(upper + lower, 1), digit / bytes_, beyond / bytes_, blank / bytes_, pipe / bytes_,
        mark / bytes_, stop / bytes_, comma / bytes_, bracket / bytes_, other / bytes_, distinct / per, top / per,
        np.bincount(text[1:][same], minlength=n) / per, np.log1p(lines), l_distinct / np.maximum(lines, 1),
        words / np.maximum(lines, 1), share(np.isin(last_kind, [4, 5, 8, 10])), share((first_kind == 0) & (length > 1)),
    ], axis=1).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        x = text_features(*utf8(batch.column(1)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients and curvatures."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl ** 2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    if not len(gain):
        return 0.0, 0
    k = int(gain.argmax())
    return float(gain[k]), k + 1


class AdditiveModel:
    """Lookup tables per feature and per pair of features, fitted by cyclic boosting of the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = 64, coarse: int = 16, rounds: int = 200,
                 pairs: int = 12, pair_rounds: int = 60, rate: float = 0.1, ridge: float = 2.0):
        n, m = x.shape
        p = (y.sum() + 0.5) / (n + 1)
        self.base = float(np.log(p / (1 - p)))
        steps = np.linspace(0, 1, bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], steps)) if n else np.zeros(0) for f in range(m)]
        self.coarse_of = [np.arange(len(e) + 1) * coarse // (len(e) + 1) for e in self.edges]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if y.min(initial=1) == y.max(initial=0):
            return
        b = self._bins(x)
        score = np.full(n, self.base)
        for _ in range(rounds):
            for f in range(m):
                g, h = self._slopes(score, y)
                size = len(self.tables[f])
                step = self._tree(np.bincount(b[:, f], g, size), np.bincount(b[:, f], h, size), ridge) * rate
                self.tables[f] += step
                score += step[b[:, f]]
        c = np.stack([self.coarse_of[f][b[:, f]] for f in range(m)], axis=1)
        g, h = self._slopes(score, y)
        found = sorted(((self._quadrants(*self._grid(c, i, j, g, h, coarse), ridge)[0], i, j)
                        for i in range(m) for j in range(i + 1, m)), reverse=True)[:pairs]
        self.pairs = [(i, j) for gain, i, j in found if gain > 0]
        self.pair_tables = [np.zeros((coarse, coarse)) for _ in self.pairs]
        for _ in range(pair_rounds):
            for k, (i, j) in enumerate(self.pairs):
                g, h = self._slopes(score, y)
                step = self._quadrants(*self._grid(c, i, j, g, h, coarse), ridge)[1] * rate
                self.pair_tables[k] += step
                score += step[c[:, i], c[:, j]]

    @staticmethod
    def _slopes(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    @staticmethod
    def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
        """A tree of depth 2 on one feature: a cut, and a cut on either side."""
        _, k = _best_cut(g, h, ridge)
        cuts = [0, k, len(g)]
        for a, b in ((0, k), (k, len(g))):
            if b - a > 1:
                gain, c = _best_cut(g[a:b], h[a:b], ridge)
                cuts += [a + c] * (gain > 0)
        cuts = sorted(set(cuts))
        out = np.zeros(len(g))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
        return out

    @staticmethod
    def _grid(c: np.ndarray, i: int, j: int, g: np.ndarray, h: np.ndarray, coarse: int) -> tuple[np.ndarray, np.ndarray]:
        cell = c[:, i] * coarse + c[:, j]
        return (np.bincount(cell, g, coarse ** 2).reshape(coarse, coarse),
                np.bincount(cell, h, coarse ** 2).reshape(coarse, coarse))

    @staticmethod
    def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
        """The best cut into four quadrants: its gain and its table."""
        gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
        quads = lambda t: (t[:-1, :-1], t[:-1, -1:] - t[:-1, :-1], t[-1:, :-1] - t[:-1, :-1],
                           t[-1, -1] - t[:-1, -1:] - t[-1:, :-1] + t[:-1, :-1])
        gq, hq = quads(gc), quads(hc)
        gain = sum(a ** 2 / (b + ridge) for a, b in zip(gq, hq, strict=True))
        r, s = np.unravel_index(int(gain.argmax()), gain.shape)
        out = np.empty_like(g)
        for k, rows, cols in ((0, slice(0, r + 1), slice(0, s + 1)), (1, slice(0, r + 1), slice(s + 1, None)),
                              (2, slice(r + 1, None), slice(0, s + 1)), (3, slice(r + 1, None), slice(s + 1, None))):
            out[rows, cols] = gq[k][r, s] / (hq[k][r, s] + ridge)
        return float(gain[r, s] - gc[-1, -1] ** 2 / (hc[-1, -1] + ridge)), out

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        total = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[self.coarse_of[i][b[:, i]], self.coarse_of[j][b[:, j]]]
        return 1 / (1 + np.exp(-total))


def fold(id_col, folds: int, held: int):
    """Whether a row is held out: crc32 of the id as text modulo ``folds`` is ``held`` (false for a null id)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == held, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.3,
                   fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; the model is fitted on labels outside the held fold."""
    spark = docs.sparkSession
    rows = stash(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                 .mapInArrow(_feature_rows, f"doc_id {dict(docs.dtypes)[id_col]}, x array<float>"), "quality-features")
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where("y in (0, 1)")
             .where(~fold(F.col("doc_id"), folds, held)))
    sample = (rows.join(known, "doc_id").withColumn("o", F.xxhash64("doc_id")).orderBy("o", "doc_id", "y")
              .limit(fit_rows).select("x", "y").toArrow())
    x = np.array(sample.column(0).to_pylist(), dtype=np.float32).reshape(-1, len(FEATURES))
    model = spark.sparkContext.broadcast(AdditiveModel(x, sample.column(1).to_numpy().astype(np.float64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(x))], ["doc_id", "score"])

    return (rows.mapInArrow(score, f"doc_id {dict(docs.dtypes)[id_col]}, score double")
            .select("doc_id", fold(F.col("doc_id"), folds, held).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
