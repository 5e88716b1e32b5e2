"""Spelling variants against a plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from obsflow.llm.spelling import frequent_words, near_pairs, spelling_variants, text_words

SCHEMA = "doc_id long, text string, word string, n int, key string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=6, times=5, ratio=5, every=199):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= least and c >= times}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-n[v], v), default=None)
        if top is not None and n[top] >= ratio * n[w]:
            form[w] = top
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n_words=60, docs=150, alphabet="abeßé"):
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(4, 9))) for _ in range(n_words)]
    words += [w[:k] + rng.choice(alphabet) + w[k + 1:] for w in words for k in (0, len(w) // 2, len(w) - 1)]
    words += [w[:k] + w[k + 1:] for w in words[:80] for k in (0, len(w) // 2, len(w) - 1)]
    weight = [rng.choice([1, 3, 20, 100]) for _ in words]
    sep = [" ", "\n", ", ", "-", "ā", " ", ". "]
    return [(rng.choice([i, i, 7, None]), "".join(w.upper() * (rng.random() < 0.1) or w
                                                  for x in rng.choices(words, weight, k=80) for w in (x, rng.choice(sep))))
            for i in range(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rows = corpus(seed) + [(1, None), (2, ""), (None, "ÀÉîôù ÀÉîôù"), (3, "1234 %%% ")]
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 10
    out = spelling_variants(table(spark, rows))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(out) == want
    assert got(spelling_variants(table(spark, rows).repartition(11))) == want


def test_every_document_word_may_lose_a_letter(spark):
    rows = corpus(5, docs=60)
    assert got(spelling_variants(table(spark, rows), every=3)) == brute(rows, every=3)


def test_pairs_of_a_crowd_of_similar_words(spark):
    """Thousands of anagrams and neighbours: nothing but true pairs, none lost."""
    rng = random.Random(9)
    words = {"".join(rng.sample("abcdefg", 7)) for _ in range(900)}
    words |= {w + "a" for w in list(words)[:300]} | {"b" + w[1:] for w in list(words)[:300]} | {"é" + w for w in list(words)[:99]}
    words = sorted(words)
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    pairs = {(r["a"], r["b"]) for r in near_pairs(df).collect()}
    want = set()
    cut = {}
    for w in words:
        for k in range(len(w)):
            cut.setdefault((w[:k] + w[k + 1:], k), []).append(w)
    known = set(words)
    for (c, _), ws in cut.items():
        want |= {(min(a, b), max(a, b)) for a in ws for b in ws if a != b}
        want |= {(min(c, w), max(c, w)) for w in ws if c in known}
    assert {tuple(sorted(p)) for p in pairs} == want and len(pairs) == len(want)


def test_long_text_is_cut_between_words(spark):
    text = ("ein längeres Wort " * 90_000) + "x" * 1_500_000 + " längeres"
    assert text_words(text) == Counter({b"ein": 90_000, "längeres".encode("latin-1"): 90_001, b"wort": 90_000,
                                        b"x" * 1_500_000: 1})
    rows = [(4, text)] + [(i, "laengeres") for i in range(5)]
    assert got(spelling_variants(table(spark, rows))) == brute(rows)


def test_ties_chains_and_empty_tables(spark):
    rows = [(1, "abcdef " * 625 + "abcdeg " * 625 + "abcdxg " * 125 + "abczxg " * 25 + "abyzxg " * 5 + "aaaaaa " * 4)]
    want = brute(rows, every=10**9 + 7)
    out = got(spelling_variants(table(spark, rows), every=10**9 + 7))
    assert out == want
    assert {r[0]: r[2] for r in out}["abyzxg"] == "abcdeg" and len(out) == 5
    assert got(spelling_variants(table(spark, []))) == []
    assert got(spelling_variants(table(spark, [(1, None), (2, "short")]))) == []
    assert frequent_words(table(spark, [])).columns == ["word", "n"]
