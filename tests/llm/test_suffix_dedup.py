"""Repeated byte strings against brute force, and the suffix array against a plain sort."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsflow.llm import suffix_dedup as module
from obsflow.llm.common import stash, stash_by_key
from obsflow.llm.suffix_dedup import difference_cover, suffix_dedup


@given(st.lists(st.integers(1, 4), max_size=90))
@settings(max_examples=200, deadline=None)
def test_suffix_array(symbols):
    s = np.array(symbols, dtype=np.int64)
    assert difference_cover(s).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(texts, length):
    seen: dict[bytes, int] = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i:i + length]] = seen.get(raw[i:i + length], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, id string")
    got = sorted(tuple(r)[:5] for r in suffix_dedup(df.repartition(3), **kw).collect())
    assert [g[1:] for g in got] == brute(texts, kw.get("length", 400))


def make(seed, alphabet="ab cdé", n=40):
    r = random.Random(seed)
    base = ["".join(r.choices(alphabet, k=r.randint(0, 400))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [r.choice(base)[r.randint(0, 40):] if r.random() < 0.6 else "".join(r.choices(alphabet, k=60))
                 for _ in range(r.randint(0, 4))]
        texts.append("".join(parts))
    return texts + ["a" * 700, "ab" * 200, None, "", "a", texts[0], texts[0]]


@pytest.mark.parametrize("group", [4096, 2])
def test_against_brute_force(spark, group):
    check(spark, make(1), length=50, gram=20, group=group)


def test_production_length(spark):
    r = random.Random(3)
    text = "".join(r.choices("abcdefgh ", k=3000))
    check(spark, [text, text[:1500] + "X" + text[1500:], "zz" + text[700:1099], "zz" + text[700:1100],
                  text[100:499] + "Q", "é" * 300, "é" * 201, "é" * 199, None, ""])


def test_long_text_in_pieces(spark):
    r = random.Random(4)
    text = "".join(r.choices("abcdefgh ", k=(1 << 19) + 3000))
    df = spark.createDataFrame([(1, text), (2, text[-2000:] + "tail"), (2, text[-2000:] + "other"), (None, text[5:900])],
                               "doc_id long, text string")
    got = {(r.id, r.n_bytes): r.spans for r in suffix_dedup(df).collect()}
    n = len(text)
    assert got[1, n] == [[5, 900], [n - 2000, n]]
    assert got[2, 2004] == [[0, 2000]] and got[2, 2005] == [[0, 2000]] and got[None, 895] == [[0, 895]]


def test_one_passage_in_most_texts(spark):
    """The names of the passage hold far more than 1/1024 of all contexts; the rows differ around it."""
    r = random.Random(5)
    word = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passage = word(300)
    check(spark, [word(90) + passage + word(90) if i % 3 else word(200) for i in range(60)], length=50, gram=20)


def test_texts_are_shuffled_once(spark):
    """Both joins with the texts read the bucketed table: no exchange above it."""
    from obsflow.plans.explain import count_exchanges, plan_text
    df = spark.createDataFrame([(i, "abcdefgh" * 100 + str(i)) for i in range(8)], "doc_id long, text string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = suffix_dedup(df)
        exchanges, plan = count_exchanges(out), plan_text(out, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert exchanges == 1   # the spans


def test_a_bucket_of_texts_is_held_in_small_parts(spark):
    """A task that writes or reads a bucket holds a row group at once, not the whole bucket."""
    r = random.Random(6)
    df = spark.createDataFrame([(i, r.randbytes(20000).hex()) for i in range(400)], "row long, text string")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        files = stash_by_key(df, "test-texts", "row").inputFiles()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    found = [m.row_group(g) for f in files for m in [pq.ParquetFile(f.removeprefix("file:")).metadata]
             for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in found) == 400
    assert max(g.total_byte_size for g in found) < 8 << 20


def test_one_worker_cuts_and_hashes(spark, monkeypatch):
    """Names with many contexts: a task hashes their strings in the Python worker that cuts them."""
    from obsflow.plans.explain import plan_text
    plans = {}

    def noted(df, name):
        plans[name] = plan_text(df, "simple")
        return stash(df, name)
    monkeypatch.setattr(module, "stash", noted)
    check(spark, make(1), length=50, gram=20, group=2)
    assert plans["repeat-strings"].count("MapInArrow") == 1


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
