"""Near-duplicate documents against brute force, with families of copies that a star alone would split."""

import random
import re

import numpy as np
import pytest

from obsflow.llm.common import components
from obsflow.llm.minhash import near_duplicates, signatures


def sets_of(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=5):
    sets = [sets_of(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = None if d is None else low[find(i)]
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bands string, n int")
    return sorted((tuple(r) for r in near_duplicates(df.repartition(3), **kw).collect()), key=repr)


def corpus(seed=2):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: r.choices(vocab, k=n)
    rows, i = [], 0
    for _ in range(12):  # chains: each copy changes a little more of the one before
        words = text(r.randint(20, 160))
        for _ in range(r.randint(1, 9)):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = r.choice(vocab)
    base = text(120)
    for _ in range(60):  # a large family around a base that is not its smallest member
        words = list(base)
        for _ in range(r.randint(2, 7)):
            words[r.randrange(len(words))] = r.choice(vocab)
        rows.append(" ".join(words))
    rows.append(" ".join(base))
    passage = text(60)
    rows += [" ".join(passage + text(60)) for _ in range(40)]  # a shared passage, no links
    rows += ["a b c", "A  B\tC", "a b", "a b c d", "A B C D e", "", None, "   ", "é É", "é é", " ".join(["x"] * 30), "x x x x"]
    r.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)] + [(None, rows[0]), (None, rows[1])]


@pytest.mark.parametrize("block,k", [(512, 4), (8, 4), (512, 5)])
def test_against_brute_force(spark, block, k):
    rows = corpus()
    rows += [rows[3], rows[4]]
    assert run(spark, rows, block=block, k=k) == brute(rows, k)


def test_a_bridge_outside_the_star_is_found(spark):
    w = [f"t{i}" for i in range(103)]
    change = lambda at: [f"u{i}" if i in at else x for i, x in enumerate(w)]
    rows = [(1, " ".join(change({10, 40}))), (2, " ".join(w)), (3, " ".join(change({70, 90})))]
    rows += [(10 + i, " ".join(change({10, 40, 55 + i}))) for i in range(3)]
    assert run(spark, rows, k=4) == brute(rows, 4)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2**64, 1300, dtype=np.uint64))
    a, b = np.sort(pool[:1000]), np.sort(pool[111:1111])
    sig = signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.12
    few = signatures(np.sort(pool[:3]), np.array([0, 3]))
    assert set(few[0].tolist()) <= set(pool[:3].tolist())


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "test").collect())
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(root)}
