"""Compression of vectors into short codes: one codebook per part of the vector, searched Orchard's way.

Every component x becomes the integer floor(256 x). Vectors are cut into equal
consecutive parts, and each part position has its own codebook, first that part
of the vectors with the smallest ids. Rounds of assignment and averaging refine
the codebooks; a last assignment gives the codes.

The nearest entry is found by Orchard's search: each entry keeps all others
sorted by their distance from it. A query starts at some entry and walks along
that entry's list; an entry that is closer takes over and its own list is
walked from the front. Entries already seen are marked and not measured again,
and a list is left as soon as its next entry is more than twice the query's
current distance away: by the triangle inequality nothing after it is closer.
All distances are squared integers, so ties (lower index wins) are exact.

Each task walks its own vectors; sums and counts per entry are added up by
Spark, and only the codebooks (entries times vector length, whatever the number
of rows) pass through the driver.

Rules: a vector that is null or holds a null or a non-finite component is left
out; vectors that are shorter than the longest one, or whose length the parts
do not divide, are filled with zeros at the end; components beyond 65,536 in
magnitude count as that; fewer kept vectors than entries give smaller
codebooks; rows with equal ids follow each other by their values; a null id
comes after all others; a sum over a label too large for 64 bits is null; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from obsflow.llm.common import stash

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest magnitude of a scaled component: squared distances of 4,096 of them stay within 64 bits.
LIMIT = 1 << 24
_ROWS = 4096


class Codebook:
    """Entries (k, width) of one part position with, for each entry, the others by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k = len(entries)
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        others = apart.copy()
        np.fill_diagonal(others, -1)  # an entry itself comes first and is cut off
        self.order = np.argsort(others, axis=1, kind="stable")[:, 1:]
        self.reach = np.take_along_axis(apart, self.order, axis=1)
        first = entries[:, 0] if entries.shape[1] else np.zeros(k, np.int64)
        self.by_first = np.argsort(first, kind="stable")
        self.first = first[self.by_first]

    def start(self, x: np.ndarray) -> np.ndarray:
        """An entry to start from: one whose first component is about the query's."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64)
        return self.by_first[np.minimum(np.searchsorted(self.first, x[:, 0]), len(self.first) - 1)]

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of each query's nearest entry, and how many distances were computed."""
        n, k = len(x), len(self.entries)
        now = self.start(x)
        best = ((x - self.entries[now]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[np.arange(n), now] = True
        at = np.zeros(n, np.int64)
        live, measured = np.arange(n), n
        while k > 1 and len(live):
            c, p = now[live], at[live]
            on = (p < k - 1) & (self.reach[c, np.minimum(p, k - 2)] <= 4 * best[live])
            live, c, p = live[on], c[on], p[on]
            at[live] += 1
            e = self.order[c, p]
            new = ~seen[live, e]
            q, e = live[new], e[new]
            seen[q, e] = True
            d = ((x[q] - self.entries[e]) ** 2).sum(axis=1)
            measured += len(q)
            take = (d < best[q]) | ((d == best[q]) & (e < now[q]))
            q, e, d = q[take], e[take], d[take]
            now[q], best[q], at[q] = e, d, 0
        return now, best, measured


def scaled(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as integers, zeros at the end up to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    off = np.asarray(column.offsets).astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
    whole = np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64)
    size = np.diff(off)
    out = np.zeros((n, width), np.int64)
    if (size == width).all():
        out[:] = whole.reshape(n, width)
    else:
        row = np.repeat(np.arange(n), size)
        out[row, np.arange(len(whole)) - (off[:-1] - off[0])[row]] = whole
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            yield batch.slice(a, _ROWS)


def _summing(books: list[Codebook], width: int):
    """Per task: for every entry the number of its parts and the sum of each component."""
    size = width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(books[0].entries)
        count, total = np.zeros((len(books), k), np.int64), np.zeros((len(books), k, size), np.int64)
        for batch in _slices(batches):
            x = scaled(batch.column(0), width)
            for p, book in enumerate(books):
                part = x[:, p * size:(p + 1) * size]
                idx, _, _ = book.search(part)
                count[p] += np.bincount(idx, minlength=k)
                for j in range(size):  # exact: 4,096 values of at most 2^24 stay far below 2^53
                    total[p, :, j] += np.bincount(idx, weights=part[:, j], minlength=k).astype(np.int64)
        p, e = np.nonzero(count)
        if len(p):
            j = np.tile(np.arange(size), len(p))
            p, e = np.repeat(p, size), np.repeat(e, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(count[p, e]), pa.array(total[p, e, j])], ["part", "entry", "pos", "n", "total"])
    return run


def _coding(books: list[Codebook], width: int):
    size = width // len(books)
    digits = np.array([f"{i:02x}" for i in range(len(books[0].entries))], dtype="U2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = scaled(batch.column(2), width)
            code, error = np.zeros(len(x), dtype="U1"), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                idx, d, _ = book.search(x[:, p * size:(p + 1) * size])
                code = np.char.add(code, digits[idx])
                error += d
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()), pa.array(error)],
                ["id", "label", "code", "error"])
    return run


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v): the rows whose vector is whole and finite, components as double."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & good).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                                                      v.alias("v"))


def fit_codebooks(kept: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook (k, width / parts) of every part position after ``rounds`` rounds over all of ``kept``."""
    size = width // parts
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()  # ``entries`` rows
    start = scaled(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width)
    books = [start[:, p * size:(p + 1) * size].copy() for p in range(parts)]
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_summing([Codebook(b) for b in books], width),
                                           "part int, entry int, pos int, n long, total long")
        found = sums.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        for r in found:  # entries times vector length, whatever the number of rows
            books[r["part"]][r["entry"], r["pos"]] = r["total"] // r["n"]
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(c) for book in books for entry in book.tolist() for c in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) for every kept row of ``vectors``.

    ``error`` is the squared distance to the coded vector over all parts,
    ``label_error`` its sum over the rows of the same label (nulls together).
    At most 256 entries, since a code has two hex digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    longest = kept.agg(F.max(F.size("v")).alias("m")).first()["m"]
    schema = StructType([StructField("id", kept.schema["id"].dataType), StructField("label", kept.schema["label"].dataType),
                         StructField("code", StringType()), StructField("error", LongType())])
    if longest is None:
        coded, digest = vectors.sparkSession.createDataFrame([], schema), codebooks_digest([])
    else:
        width = max(1, -(-longest // parts)) * parts
        books = fit_codebooks(kept, width, parts, entries, rounds)
        digest = codebooks_digest(books)
        coded = stash(kept.select("id", "label", "v").mapInArrow(
            _coding([Codebook(b) for b in books], width), schema), "codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return (coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
