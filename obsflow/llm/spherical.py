"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

Filter directions are all concatenations of one codeword per half of the
(randomly rotated) space. List decoding finds, for each vector, every filter
whose direction scores above the vector's cap height, the score of its
``caps``-th best filter, from the ranks of the two halves alone. Vectors that
share a filter and a label meet in blocks of bounded size and are compared by
cosine in double precision; a pair counts only under the smallest filter the
two share, so each link is found once. Equal vectors are one weighted node.

In few dimensions the best filters of two close vectors may all differ, since
a filter's cap is then small; vectors of fewer than ``FEW`` dimensions share
one filter per label and length instead, and all of them meet block by block.

Rules: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or id, link with nothing (a null id has
a null component and stays); vectors of different length never link; equal
rows count as separate vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import components, shuffle_width, sorted_groups, stash
from obsflow.llm.words import mix64

CODEWORDS, CAPS, BLOCK = 64, 20, 1024
#: Dimensions from which filters tell vectors apart without losing links.
FEW = 16


class ProductCode:
    """``codewords`` random unit directions for each half of a randomly rotated space."""

    def __init__(self, dim: int, codewords: int, seed: int = 11):
        rng = np.random.default_rng([seed, dim])
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.half = dim // 2
        self.books = []
        for width in (self.half, dim - self.half):
            book = rng.normal(size=(codewords, max(width, 1)))
            self.books.append((book / np.linalg.norm(book, axis=1, keepdims=True))[:, :width])
        self.codewords = codewords

    def decode(self, unit: np.ndarray, caps: int) -> np.ndarray:
        """The ``caps`` best filters of each row, sorted by number.

        A pair of ranks (i, j) is beaten or met by (i + 1) * (j + 1) pairs, so the
        best ones have (i + 1) * (j + 1) <= caps.
        """
        caps = min(caps, self.codewords ** 2)
        x = unit @ self.rotation
        scores = [x[:, :self.half] @ self.books[0].T, x[:, self.half:] @ self.books[1].T]
        order = [np.argsort(-s, axis=1)[:, :caps] for s in scores]
        ranks = [(i, j) for i in range(order[0].shape[1]) for j in range(order[1].shape[1]) if (i + 1) * (j + 1) <= caps]
        i, j = np.array(ranks).T
        one, two = order[0][:, i], order[1][:, j]
        total = np.take_along_axis(scores[0], one, 1) + np.take_along_axis(scores[1], two, 1)
        best = np.argsort(-total, axis=1, kind="stable")[:, :caps]
        number = np.take_along_axis(one * self.codewords + two, best, 1)
        return np.sort(number, axis=1).astype(np.int32)

    def filters(self, unit: np.ndarray, caps: int) -> np.ndarray:
        """``decode``, or the one filter of all vectors below ``FEW`` dimensions."""
        return self.decode(unit, caps) if unit.shape[1] >= FEW else np.zeros((len(unit), 1), dtype=np.int32)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) per vector length of the rows that can link."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for dim in np.unique(size[valid]):
        rows = np.flatnonzero(valid & (size == dim))
        if not dim:
            continue
        m = flat[off[rows][:, None] + np.arange(dim)[None, :]]
        with np.errstate(over="ignore"):
            ok = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
        yield rows[ok], m[ok] + m.dtype.type(0)  # -0 becomes 0


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input (vec_id, label, embedding); adds the length, a 128-bit key and the bytes of vectors that can link."""
    for batch in batches:
        n = batch.num_rows
        dim, k1, k2 = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        raw: list[bytes | None] = [None] * n
        for rows, m in _vectors(batch.column(2)) if n else ():
            dim[rows] = m.shape[1]
            words = np.ascontiguousarray(m.astype(np.float64)).view(np.uint64)
            for out, salt in ((k1, 3), (k2, 5)):
                spread = mix64(np.arange(1, m.shape[1] + 1, dtype=np.uint64) * np.uint64(salt))
                out[rows] = mix64((mix64(words + spread) * (spread | np.uint64(1))).sum(axis=1, dtype=np.uint64)).view(np.int64)
            for r, v in zip(rows, m, strict=True):
                raw[r] = v.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dim), pa.array(k1), pa.array(k2), pa.array(raw, pa.binary())],
            ["vec_id", "label", "dim", "k1", "k2", "raw"])


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    width = len(raw[0]) // dim
    m = np.frombuffer(b"".join(raw), dtype=np.float32 if width == 4 else np.float64).reshape(-1, dim).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # so that squares of extreme components stay finite
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _decoder(codewords: int, caps: int):
    """Adds the filters of each vector to (cls, label, dim, weight, raw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                dims, raw = part.column(2).to_numpy(), part.column(4).to_pylist()
                lists: list[list[int]] = [[]] * part.num_rows
                for dim in np.unique(dims).tolist():
                    code = codes.setdefault(dim, ProductCode(dim, codewords))
                    rows = np.flatnonzero(dims == dim)
                    for r, f in zip(rows, code.filters(_unit([raw[r] for r in rows], dim), caps).tolist(), strict=True):
                        lists[r] = f
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))],
                                                 [*part.schema.names, "filters"])
    return run


def _linker(threshold: float):
    """Groups are (label, dim, filter, i, j): block i against block j of a bucket (against itself if equal)."""
    def solve(t: pa.Table) -> tuple[np.ndarray, ...]:
        f, i, j = (t.column(k)[0].as_py() for k in (2, 3, 4))
        cls, weight, chunk = (t.column(k).to_numpy() for k in (5, 6, 7))
        x = _unit(t.column(8).to_pylist(), t.column(1)[0].as_py())
        link = x @ x.T >= threshold
        np.fill_diagonal(link, False)
        if i != j:
            link &= chunk[:, None] != chunk[None, :]
        if link.any():
            lists = t.column(9).combine_chunks()
            flat, owner = lists.values.to_numpy(), np.repeat(np.arange(len(cls)), np.diff(lists.offsets.to_numpy()))
            flat = flat[lists.offsets.to_numpy()[0]:][:len(owner)]
            below = flat < f
            names, at = np.unique(flat[below], return_inverse=True)
            has = np.zeros((len(cls), len(names)), dtype=np.float32)
            has[owner[below], at] = 1
            link &= has @ has.T == 0  # the two share no smaller filter
        some = link.any(axis=1)
        root = np.arange(len(cls))
        while some.any():  # smallest row reachable inside the group
            low = np.where(link, root[None, :], len(cls)).min(axis=1)
            new = np.minimum(root, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return cls[some], (link[some] * weight[None, :]).sum(axis=1), cls[root[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, 5):
            if t.num_rows > 1:
                a, n, b = solve(t)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(n.astype(np.int64)), pa.array(b)],
                                                     ["a", "n", "b"])
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, codewords: int = CODEWORDS, caps: int = CAPS,
                 block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``."""
    spark = vectors.sparkSession
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                            F.col(vector_col).alias("v"))
    rows = stash(source.mapInArrow(_keyed, "vec_id long, label long, dim int, k1 long, k2 long, raw binary"),
                 "vectors-rows")
    key = ["label", "dim", "k1", "k2"]
    able = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.col("dim") > 0)
    classes = stash(rows.where(able).groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
                                                       F.first("raw").alias("raw"))
                    .withColumn("cls", F.monotonically_increasing_id()), "vectors-classes")
    decoded = stash(classes.select("cls", "label", "dim", "weight", "raw").mapInArrow(
        _decoder(codewords, caps), "cls long, label long, dim int, weight long, raw binary, filters array<int>"),
        "vectors-filters")
    bucket = ["label", "dim", "filter"]
    posting = decoded.select("cls", "label", "dim", F.explode("filters").alias("filter"))
    sizes = posting.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    sizes = stash(sizes.withColumn("chunks", F.ceil(F.col("m") / block).cast("int")), "vectors-buckets")
    placed = (decoded.withColumn("filter", F.explode("filters")).join(sizes, bucket)
              .withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    blocks = placed.select(*bucket, F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                           "cls", "weight", "chunk", "raw", "filters")
    where = [*bucket, "i", "j"]
    found = (blocks.repartition(shuffle_width(spark), *where).sortWithinPartitions(*where)
             .mapInArrow(_linker(threshold), "a long, n long, b long"))
    found = stash(found, "vectors-links")
    label = components(found.select("a", "b"), "vectors")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = (classes.select(*key, "cls", "rep", "weight").join(counts.withColumnRenamed("a", "cls"), "cls", "left")
             .join(label.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    named = stash(named.join(smallest, "component").select(
        *key, (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"), "smallest"), "vectors-named")
    out = rows.select("vec_id", *key).withColumn("able", able).join(named, key, "left")
    cid = F.when(F.col("able"), F.col("smallest")).otherwise(F.col("vec_id"))
    return (out.withColumn("component_id", cid)
            .select("vec_id", F.when(F.col("able"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                    "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))
