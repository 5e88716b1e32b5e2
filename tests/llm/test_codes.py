"""Vector codes against a plain nearest-entry search."""

import hashlib
import math
import random

import numpy as np
import pytest

from obsflow.llm.codes import Codebook, compress, scaled

SCHEMA = "vec_id long, embedding array<double>, label int, code string, id string"


def brute(rows, parts=16, entries=64, rounds=2):
    ok = [(i, v, lab) for i, v, lab in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not ok:
        return {}
    width = max(1, -(-max(len(v) for _, v, _ in ok) // parts)) * parts
    size = width // parts
    ints = [([math.floor(256 * c) for c in v] + [0] * width)[:width] for _, v, _ in ok]
    cut = [[x[p * size:(p + 1) * size] for p in range(parts)] for x in ints]
    order = sorted(range(len(ok)), key=lambda r: (ok[r][0] is None, ok[r][0] or 0, ok[r][1]))
    books = [[cut[r][p] for r in order[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k)
                               for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = [[] for _ in books[p]]
            for c in cut:
                got[near(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(t) // len(g) for t in zip(*g, strict=True)] if g else e
                        for g, e in zip(got, books[p], strict=True)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for (i, _, lab), c in zip(ok, cut, strict=True):
        d = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in d), sum(x for x, _ in d), lab))
    total = {}
    for *_, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, code, e, total[lab], digest) for i, code, e, lab in out), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("dim,n", [(64, 300), (16, 40), (40, 90)])
def test_codes_equal_brute_force(spark, dim, n):
    rng = random.Random(dim)
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centre)], rng.choice([None, 1, 1, 1, 2])) for i in range(n)]
    rows += [(n + i, rows[i][1], 2) for i in range(20)]                 # copies
    rows += [(n + 50, None, 1), (n + 51, [1.0, None] * (dim // 2), 1), (n + 52, [float("nan")] * dim, 2),
             (n + 53, [float("inf")] * dim, None), (None, rows[3][1], 1), (5, rows[7][1], 1),
             (-4, [0.0] * dim, 7), (-5, [-1 / 512] * dim, 7)]
    df = table(spark, rows)
    out = compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(out) == brute(rows)
    assert got(compress(df.repartition(7))) == brute(rows)


def test_short_empty_and_few_vectors(spark):
    rows = [(1, [0.5] * 20, 1), (2, [0.25] * 7, 1), (3, [], None), (4, [-0.75] * 3, None)]
    assert got(compress(table(spark, rows))) == brute(rows)
    assert got(compress(table(spark, [(9, [], 1)]))) == brute([(9, [], 1)])
    none = compress(table(spark, [(1, None, 1), (2, [None], 2)]))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert compress(table(spark, [])).collect() == []


def test_one_label_with_nearly_all_rows_and_very_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(16)], 1 if i % 20 else i) for i in range(400)]
    assert got(compress(table(spark, rows), entries=7, rounds=1)) == brute(rows, entries=7, rounds=1)
    huge = [(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1), (3, [65536.0] * 16, 2)]
    out = {r["vec_id"]: r for r in compress(table(spark, huge)).collect()}
    assert out[1]["code"] == out[3]["code"] and out[1]["error"] == 0


def test_orchard_search_finds_the_nearest_entry_with_fewer_distances():
    rng = np.random.default_rng(5)
    near = total = 0
    for k, w in [(1, 4), (2, 3), (64, 4), (64, 1), (50, 8)]:
        entries = rng.integers(-40, 40, (k, w))
        entries[k // 2] = entries[0]                                    # equal entries: the lower index wins
        x = np.concatenate([rng.integers(-60, 60, (500, w)), entries])
        idx, d, measured = Codebook(entries).search(x)
        all_d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (idx == all_d.argmin(axis=1)).all() and (d == all_d.min(axis=1)).all()
        near, total = near + measured, total + len(x) * k
    assert near < 0.6 * total


def test_scaled_floors_downwards():
    import pyarrow as pa
    x = scaled(pa.array([[-0.001, 0.001, -1.0], [0.999]], pa.list_(pa.float64())), 4)
    assert x.tolist() == [[-1, 0, -256, 0], [255, 0, 0, 0]]
