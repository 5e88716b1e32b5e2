"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from obsflow.llm.spherical import ProductCode, near_vectors


def brute(rows, threshold=0.98):
    def ok(i, v, label):
        return (i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    n = len(rows)
    link = [[] for _ in rows]
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(v) if ok(i, v, lab) else None for i, v, lab in rows]
    for a in range(n):
        for b in range(a):
            if (unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
                    and unit[a] @ unit[b] >= threshold):
                link[a].append(b)
                link[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        c = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((rows[a][0], len(link[a]), c, rows[a][0] == c))
    return sorted(out, key=repr)


def run(spark, rows, kind=None, **kw):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(kind or FloatType())),
                         StructField("label", IntegerType()), StructField("cls", StringType())])
    df = spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(3)
    return sorted((tuple(r) for r in near_vectors(df, **kw).collect()), key=repr)


def corpus(dim=24, n=160):
    rng = np.random.default_rng(3)
    rows = []
    centres = rng.normal(size=(12, dim))
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.1, 0.15])
        rows.append((i, np.float32(v * rng.choice([1, 2])).tolist(), int(rng.integers(3))))
    rows += [(900, None, 1), (901, [0.0] * dim, 1), (902, [None] * dim, 1), (903, [float("nan")] * dim, 1),
             (904, rows[0][1], None), (None, rows[0][1], rows[0][2]), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1),
             (908, [float("inf")] + [1.0] * (dim - 1), 1), (909, [1.0], 2), (910, [-1.0], 2), (911, [3.0], 2)]
    return rows + [rows[4], (950, rows[4][1], rows[4][2]), (951, rows[4][1], rows[4][2])]


@pytest.mark.parametrize("block", [1024, 5])
def test_against_brute_force(spark, block):
    rows = corpus()
    assert run(spark, rows, block=block) == brute(rows)


def test_double_vectors_with_extreme_components(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, [1e300, -1e300], 0), (4, [-0.0, 1.0], 0), (5, [0.0, 5.0], 0)]
    got = run(spark, rows, DoubleType())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_decoding_lists_the_best_filters():
    code = ProductCode(10, 8)
    x = np.random.default_rng(1).normal(size=(50, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = x @ code.rotation
    full = ((r[:, :5] @ code.books[0].T)[:, :, None] + (r[:, 5:] @ code.books[1].T)[:, None, :]).reshape(50, -1)
    want = np.sort(np.argsort(-full, axis=1)[:, :12], axis=1)
    assert (code.decode(x, 12) == want).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    code = ProductCode(64, 64)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x, z = unit(rng.normal(size=(4000, 64))), rng.normal(size=(4000, 64))
    z = unit(z - (z * x).sum(1, keepdims=True) * x)
    a, b = code.decode(x, 20), code.decode(0.98 * x + math.sqrt(1 - 0.98 ** 2) * z, 20)
    found = sum(bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist(), strict=True))
    assert found >= 3996


@pytest.mark.parametrize("dim", [1, 2, 3, 4, 6, 8, 12, 15, 16])
def test_no_link_is_lost_in_few_dimensions(spark, dim):
    """Pairs just above and below the threshold, in blocks smaller than the buckets."""
    rng = np.random.default_rng(dim)
    rows = []
    for i in range(60):
        x = rng.normal(size=dim)
        y = rng.normal(size=dim)
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        for cosine in (0.981, 0.9799):
            side = y / (np.linalg.norm(y) or 1.0) * np.sqrt(1 - cosine**2) if dim > 1 else 0.0
            rows.append((len(rows), (cosine * x + side).tolist(), 1 + i % 2))
        rows.append((len(rows), x.tolist(), 1 + i % 2))
    want = brute(rows)
    assert sum(r[1] for r in want) >= 120
    assert run(spark, rows, block=64) == want
