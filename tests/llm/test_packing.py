"""Packing: every id once, whole sequences, target proportions; ids equal to the tokenizer's own."""

import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from obsflow.llm.packing import Encoder, RoundRobin, own_queues, pack, sequences  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, ids string, queue int"
COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(PATH)


def served_one_by_one(sizes, weights, per_window, grain):
    """Grains handed out one at a time to the queue whose next one falls due first."""
    left, given, order = [s // grain for s in sizes], [0] * len(sizes), []
    while any(left):
        q = min((k for k in range(len(sizes)) if left[k]), key=lambda k: ((given[k] + 1 << 80) // weights[k], k))
        order.append(q)
        given[q] += 1
        left[q] -= 1
    return [order[a:a + per_window] for a in range(0, len(order), per_window)]


@pytest.mark.parametrize("sizes,weights", [
    ([1000, 5000, 77, 0, 12345], None), ([64, 64, 64], None), ([9000, 9000, 100], [1, 5, 2]), ([0, 0], None),
    ([4096 * 3], None), ([1, 2, 3], None), ([30000, 12, 700, 64, 128], [3, 1, 1, 7, 2])])
def test_windows_equal_serving_grain_by_grain(sizes, weights):
    r = RoundRobin(sizes, weights, length=512, grain=16)
    want = served_one_by_one(sizes, r.weights, 32, 16)
    have = [0] * len(sizes)
    for w, got in enumerate(want):
        assert r.cut(w) == have
        for q in got:
            assert r.window(q, have[q]) == w
            have[q] += 1
    assert r.cut(len(want)) == have
    # every token of every queue has one place; sequences are full or a power of two
    place = {}
    for q, n in enumerate(sizes):
        a = 0
        for step in iter(lambda: random.Random(a).randint(1, 300), None):
            b = min(n, a + step)
            at = a
            for lo, hi, seq, off in r.pieces(q, a, b):
                assert lo == at and hi > lo
                at = hi
                for k in range(hi - lo):
                    assert place.setdefault((seq, off + k), (q, lo + k)) == (q, lo + k)
            assert at == b
            a = b
            if a == n:
                break
    fill = {}
    for seq, _ in place:
        fill[seq] = fill.get(seq, 0) + 1
    assert sum(fill.values()) == sum(sizes) and sorted(fill) == list(range(len(fill)))
    assert all((s, n - 1) in place and (n == 512 or n & (n - 1) == 0) for s, n in fill.items())


def test_every_window_keeps_the_proportions_and_carries_deficits():
    sizes = [64 * n for n in (50_000, 1_000, 7, 12_345, 800)]
    r = RoundRobin(sizes)
    for w in range(0, r.total // 64, 37):
        for q, n in enumerate(r.cut(w)):
            assert abs(n - Fraction(64 * w * r.grains[q], r.total)) < len(sizes)   # fewer grains behind or ahead than queues
    skewed = RoundRobin(sizes, [1, 1, 1, 2, 1])
    assert skewed.cut(20)[2] == 7 and abs(skewed.cut(20)[3] - 2 * skewed.cut(20)[0]) < 3


def test_ids_equal_the_tokenizer(own):
    e = Encoder(PATH)
    assert e.by_word
    texts = ["", "Hello  WORLD's 12,5% it's we'll", "Ärger über ÷ × ß naïve ÿ ªº µm x²", "á ẹ́ ́x",
             "<|endoftext|> a<|startoftext|>b <|end", "tabs\t\n\r\x0b\x0c\x1c\x1d\x85\xa0nbsp  em　wide", "ΣΑΣ İstanbul ǅ",
             "中文 テキスト 한국어 🙂👍🏽 a🙂b", "don't'S 'LL 'd''s '", "\x00\x01nul", "x" * 5000, "１２ ½ Ⅷ", "ﬁ ﬂ K Å"]
    rng = random.Random(1)
    pool = "aB é'ßs.,-1 \ń 中<|>tÿ÷\xa0"
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for t, want in zip(texts, own.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(e(t.encode()), e.type).tolist() == [*want.ids, 2], repr(t)
    long = "Wörter und words " * 90_000
    assert np.frombuffer(e(long.encode()), e.type).tolist() == [*own.encode(long, add_special_tokens=False).ids, 2]


def test_different_words_of_many_texts_are_tokenized_once(own, monkeypatch):
    """Slices of texts give the ids of each text; a run of letters reaches the model once, in any case and beside any signs."""
    texts = ["Alpha, alpha ALPHA!", None, "", "  ", "\tÉté été.\n", "alpha 中文 beta", "(beta)###", "<|endoftext|>Beta beta", "J\u030c j\u030c",
             "it's don'treet", "alpha " * 50] * 3
    e = Encoder(PATH)
    asked, tokenize = [], e.tokenize
    e.tokenize = lambda part: asked.append(part) or tokenize(part)
    want = [[*x.ids, 2] for x in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    assert [np.frombuffer(x, e.type).tolist() for x in e.many(column)] == want
    assert [np.frombuffer(x, e.type).tolist() for x in e.many(column.slice(3, 9))] == want[3:12]
    assert len(asked) == len(set(asked)) and {"alpha", "beta"} <= set(asked)
    assert e.many(pa.array([], pa.binary())) == []
    monkeypatch.setattr("obsflow.llm.packing._BYTES", 40)   # texts beyond this are cut at blanks
    assert [np.frombuffer(x, e.type).tolist() for x in e.many(column)] == want


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, own = Encoder(path, end_id=50256), Tokenizer.from_file(path)
    assert not e.by_word
    for t in ["", "two  blanks and\n lines", "ÿ <|endoftext|> x"]:
        assert np.frombuffer(e(t.encode()), e.type).tolist() == [*own.encode(t, add_special_tokens=False).ids, 50256]


def check(rows, pieces, own, length=4096):
    """Each id lies in one piece, sequences are gapless and full or a power of two."""
    want = {}
    for i, t, _ in rows:
        ids = tuple([*own.encode(t or "", add_special_tokens=False).ids, 2])
        want.setdefault((i, len(ids)), []).append(ids)
    seqs, docs = {}, {}
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
    assert sorted(seqs) == list(range(len(seqs)))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    assert set(docs) == set(want)
    for key, parts in docs.items():
        if len(want[key]) == 1:
            assert [x for _, p in sorted(parts) for x in p] == list(want[key][0])
        else:
            assert sum(len(p) for _, p in parts) == key[1] * len(want[key])
    return seqs


def test_pack_whole_tables(spark, own):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma's", "1234", "über", "中文", ", "]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 30, 400]))), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    rows += [(1000, None, None), (None, "null id", "s1"), (7, "again", "s1"), (7, "again", "s1"), (1001, "alpha " * 30_000, "s2"),
             (1002, "", None)] + [(2000 + i, "tiny", f"host{i}") for i in range(80)]
    out = pack(table(spark, rows), PATH)
    assert out.columns == COLUMNS
    got = out.collect()
    seqs = check(rows, got, own)
    assert sum(n for p in seqs.values() for _, n in p) == sum(
        len(own.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    again = pack(table(spark, rows), PATH).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    whole = {r["sequence_id"]: r["ids"] for r in sequences(out).collect()}
    assert all(len(whole[s]) == 4 * sum(n for _, n in p) for s, p in seqs.items())
    for r in got[:50]:
        at = 4 * r["offset"]
        assert zlib.crc32(whole[r["sequence_id"]][at:at + 4 * r["length"]]) == zlib.crc32(r["ids"])


def test_windows_hold_target_proportions(spark, own):
    rows = [(i, "word " * 700, "a" if i % 4 == 0 else "b") for i in range(160)]
    src = {i: s for i, _, s in rows}
    share = {}
    for r in pack(table(spark, rows, 5), PATH, weights={"a": 1, "b": 1}).collect():
        share.setdefault(r["sequence_id"], {"a": 0, "b": 0})[src[r["doc_id"]]] += r["length"]
    a_windows = 40 * 701 // 2048 - 1
    assert all(abs(share[w]["a"] - 2048) <= 64 for w in range(a_windows))       # equal shares while "a" lasts
    assert all(share[w]["b"] == 4096 for w in range(a_windows + 3, 25))         # then all of the rest
    natural = {}
    for r in pack(table(spark, rows, 5), PATH).collect():
        natural.setdefault(r["sequence_id"], {"a": 0, "b": 0})[src[r["doc_id"]]] += r["length"]
    assert all(abs(natural[w]["a"] - 1024) <= 64 for w in range(26))


def test_queues_and_empty_tables(spark):
    df = table(spark, [(i, "x" * 100, None if i % 2 else "even") for i in range(90)] + [(99, "x", "small")])
    assert own_queues(df, "text", "source", 64) == ["even", None]
    assert len(own_queues(table(spark, [(i, "text", f"s{i:03}") for i in range(300)]), "text", "source", 64)) == 0
    empty = pack(table(spark, []), PATH)
    assert empty.columns == COLUMNS and empty.collect() == []
    one = pack(table(spark, [(5, None, None)]), PATH).collect()
    assert [(r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["sequence_id"], r["offset"]) for r in one] == [(5, 0, 1, 1, 0, 0)]
