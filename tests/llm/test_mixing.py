"""Source mixing against brute force."""

import hashlib
import itertools
import math
import random
import re

import pytest

from obsflow.llm import mixing
from obsflow.llm.mixing import mix


def brute(rows, weights=(1, 2, 3), cap=3, block=None, phi=(math.sqrt(5) - 1) / 2):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = {}
    for i, t, s in rows:
        by.setdefault(s, []).append((hashlib.md5(str("" if i is None else i).encode()).hexdigest(),
                                     (i is not None, i or 0), size(t), i))
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = {s: sum(d[2] for d in by[s]) for s in names}
    target, free, left = {}, list(names), float(sum(total.values()))
    while free:
        share = left / sum(w[s] for s in free)
        over = [s for s in free if share * w[s] >= cap * total[s]]
        if not over:
            target |= {s: share * w[s] for s in free}
            break
        for s in over:
            target[s] = float(cap * total[s])
            left -= target[s]
            free.remove(s)
    words = sum(total.values())
    block = block or max(1, -(-words // 2**20))
    blocks = {s: -(-total[s] // block) for s in names}
    slots = [target[s] * blocks[s] / total[s] if total[s] else 0.0 for s in names]
    edges = list(itertools.accumulate(slots))
    n = max(0, math.ceil(edges[-1] - 1e-6)) if edges else 0
    given = {s: [] for s in names}                      # per source its slots in order
    for k in range(n):
        u = (k + 1) * phi - math.floor((k + 1) * phi)
        x = next((i for i, e in enumerate(edges) if u < e / edges[-1]), None)
        if x is not None:
            given[names[x]].append(k)
    out = []
    for s in names:
        use = [k for k in given[s][:cap * blocks[s]]]
        first, times = {}, {}
        for r, k in enumerate(use):
            first.setdefault(r % blocks[s], k)
            times[r % blocks[s]] = times.get(r % blocks[s], 0) + 1
        at = 0
        for *_, n_words, i in sorted(by[s], key=lambda d: d[:3]):
            mine = [w // block for w in range(at, at + n_words)]
            out.append((i, n_words, total[s], round(target[s], 6), sum(times.get(x, 0) for x in mine),
                        min((first[x] for x in mine if x in first), default=None)))
            at += n_words
    return sorted(out, key=repr)


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, size int, rk string")
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.first_slot)
                   for r in mix(df.repartition(parts), **kw).collect()), key=repr)


def corpus():
    r = random.Random(8)
    rows = [(i, " \t".join(["w"] * r.randint(0, 90)), r.choice(["a"] * 6 + ["b", "c", "é", None, "tiny"])) for i in range(150)]
    return rows + [(200, None, "a"), (201, "", "only empty"), (None, "x y", "b"), (7, "x y", "a"), (7, "x y", "a"),
                   (300, "one", "single"), (301, "v " * 9000, "huge")]


@pytest.mark.parametrize("block", [7, 1024])
def test_against_brute_force(spark, block):
    rows = corpus()
    assert run(spark, rows, block_words=block, bucket_docs=10) == brute(rows, block=block)


def test_reruns_agree_whatever_the_layout(spark):
    rows = corpus()
    assert run(spark, rows, 1) == run(spark, rows[::-1], 5)


def test_limits(spark):
    got = run(spark, corpus())
    assert all(t <= 3 * n for _, n, _, _, t, _ in got)
    taken = {}
    for _, _, size, target, t, _ in got:
        taken.setdefault((size, target), []).append(t)
    assert all(abs(sum(t) - target) <= 3 + target / 1000 for (_, target), t in taken.items())


def test_the_schedule_decides(spark, monkeypatch):
    """Other points give another mix, and the brute force with those points the same one."""
    rows = corpus()
    golden = run(spark, rows, block_words=16)
    monkeypatch.setattr(mixing, "PHI", math.sqrt(2) - 1)
    other = run(spark, rows, block_words=16)
    assert other == brute(rows, block=16, phi=math.sqrt(2) - 1) and other != golden
    monkeypatch.setattr(mixing, "PHI", 0.5)                     # two points only: most sources get nothing
    assert run(spark, rows, block_words=16) == brute(rows, block=16, phi=0.5)


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "a")], [(1, "a b", None)]])
def test_small_tables(spark, rows):
    assert run(spark, rows) == brute(rows)
