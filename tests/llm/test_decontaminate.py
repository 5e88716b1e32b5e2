"""Decontamination against brute force, and the index against plain search."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsflow.llm.decontaminate import contamination
from obsflow.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=13):
    phrases = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - n + 1) if w else 0):
            phrases.setdefault(tuple(w[a:a + n]), set()).add("" if i is None else str(i))
    sizes = {len(p) for p in phrases}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                if tuple(w[a:a + m]) in phrases:
                    hit |= set(range(a, a + m))
                    found |= phrases[tuple(w[a:a + m])]
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, th string").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, item string")
    got = contamination(d, b, **kw).collect()
    for r in got:
        assert sum(s.w1 - s.w0 for s in r.spans) == r.n_hit
    return sorted(((r.row_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in got), key=repr)


def corpus():
    r = random.Random(6)
    vocab = ["the", "of", "Én", "x1", "and", "to"] + [f"v{i}" for i in range(30)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([13, 14, 30])))) for i in range(25)]
    items += [(30, "zz yy"), (31, ""), (32, None), (None, items[0][1]), (33, items[1][1]), (2, items[3][1]), (34, "...")]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 4)):
            t = (r.choice(items)[1] or "").split()
            a = r.randint(0, 3)
            parts += r.choice([t, t[a:], t[:13], r.choices(vocab, k=40), ["ZZ", "yy,"]])
        docs.append((i, r.choice([" ", ", ", "\n"]).join(parts).replace("the", r.choice(["the", "The", "THE"]))))
    docs += [(100, None), (101, ""), (102, "..."), (None, items[5][1]), (7, docs[8][1]), (9, docs[9][1]), (9, docs[9][1])]
    docs += [(200, ("pad " * 3000) + items[0][1]), (201, (items[0][1] + " ") * 40)]
    return docs, items


@pytest.mark.parametrize("blocks", [200_000, 60])
def test_against_brute_force(spark, blocks):
    docs, items = corpus()
    assert run(spark, docs, items, block_phrases=blocks) == brute(docs, items)


def test_spans_are_bytes_of_the_text(spark):
    docs = spark.createDataFrame([(1, "é one, TWO three! x one two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    (r,) = contamination(docs, bench).collect()
    raw = "é one, TWO three! x one two three".encode()
    assert [raw[s.b0:s.b1].decode() for s in r.spans] == ["one, TWO three", "one two three"]


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a b")], []), ([], []), ([(1, None)], [(None, None)])])
def test_small_tables(spark, docs, items):
    assert run(spark, docs, items) == brute(docs, items)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.lists(st.integers(1, 3), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_index(symbols, phrase):
    sym = np.array([*symbols, 0], dtype=np.int64)
    index = FMIndex(sym, 4)
    want = [i for i in range(len(sym)) if sym[i:i + len(phrase)].tolist() == phrase]
    which, lo, hi = index.search(np.array([phrase], dtype=np.int64))
    got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) if len(which) else []
    assert got == want
