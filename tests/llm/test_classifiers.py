"""Quality and toxicity models: held-out accuracy, folds, gradients, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm.common import utf8
from obsflow.llm.quality import FEATURES, AdditiveModel, quality_scores, text_features
from obsflow.llm.toxicity import FIT_ROWS, INPUTS, WINDOW, Network, Scorer, Words, toxicity_scores, windows
from tests.conftest import SF01

SF1 = "/root/testdata/sf0.1"


def arrays(texts):
    import pyarrow as pa
    return utf8(pa.array(texts, pa.string()))


def auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def held(spark, scores, label):
    y = spark.read.parquet(f"{SF1}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    return [(r.score, r.y, r.predicted) for r in scores.where("held_out").join(y, "doc_id").collect()]


def test_quality_held_out(spark):
    out = quality_scores(spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet"))
    rows = held(spark, out, "quality")
    assert auc([r[:2] for r in rows]) > 0.97
    assert np.mean([p == y for _, y, p in rows]) > 0.95


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    rows = held(spark, toxicity_scores(docs, docs, spark.read.parquet(f"{SF1}/labels.parquet")), "toxic")
    assert auc([r[:2] for r in rows]) > 0.9
    assert np.mean([p for _, y, p in rows if y == 1]) > 0.8
    assert np.mean([p for _, y, p in rows if y == 0]) < 0.05


@pytest.mark.parametrize("score,folds,kept", [(quality_scores, 5, 0), (lambda d, lab: toxicity_scores(d, d, lab), 4, 2)])
def test_edges(spark, score, folds, kept):
    texts = ["plain words here", None, "", "   ", "x" * 3_000_000, "word " * 200_000, "é|!$ 12\n\n", "same", "same", "same"]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    docs = spark.createDataFrame(list(zip(ids, texts, [0.5] * 10, ["a"] * 10, strict=True)),
                                 "doc_id long, text string, score double, y string")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (7, 0, 1), (8, 1, 0), (8, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = score(docs, labels).select("doc_id", "held_out", "score", "predicted").collect()
    assert sorted(r.doc_id or 0 for r in rows) == sorted(i or 0 for i in ids)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == kept)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len({r.score for r in score(docs, empty).collect()}) == 1
    assert score(docs.limit(0), labels).collect() == []


def test_labels_of_the_held_fold_change_nothing(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    for score, mod, rest in ((quality_scores, 5, 0), (lambda d, lab: toxicity_scores(d, d, lab), 4, 2)):
        flip = lambda c: F.when(fold % mod == rest, 1 - F.col(c)).otherwise(F.col(c)).alias(c)  # noqa: B023, E731
        a = dict(score(docs, labels).select("doc_id", "score").collect())
        b = dict(score(docs, labels.select("doc_id", flip("quality"), flip("toxic"))).select("doc_id", "score").collect())
        assert a == b


def test_rows_over_the_length_bound_take_no_place_in_the_fit_sample(spark):
    assert FIT_ROWS >= 6_000
    short = [(i, "vile scorn" if i % 2 else "plain words") for i in range(40)]
    both = short + [(i, "long " * 50) for i in range(40, 400)]
    got = []
    for rows in (short, both):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
        got.append(dict(toxicity_scores(docs, docs, labels, fit_rows=30, fit_bytes=100).select("doc_id", "score").collect()))
    assert all(got[0][i] == pytest.approx(got[1][i], abs=1e-6) for i, _ in short)
    assert min(got[1][i] for i in range(1, 40, 2)) > 0.5 > max(got[1][i] for i in range(0, 40, 2))


def test_features_by_hand():
    x = dict(zip(FEATURES, text_features(*arrays(["Ab, ab ab\nC1|", ""]))[0], strict=True))
    assert x["log_words"] == pytest.approx(np.log1p(4)) and x["log_lines"] == pytest.approx(np.log1p(2))
    assert x["top_word"] == 0.5 and x["repeats"] == 0.25 and x["pipes"] == pytest.approx(1 / 13)
    assert x["upper"] == pytest.approx(2 / 7) and x["distinct_words"] == 0.75


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = AdditiveModel(x, y, rounds=20)
    assert (0, 1) in model.pairs[:1]
    z = rng.normal(size=(1000, 4)).astype(np.float32)
    assert (((model.score(z) > 0.5) == ((z[:, 0] > 0) ^ (z[:, 1] > 0))).mean()) > 0.93


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = Network()
    net.p = {k: v.astype(np.float64) + rng.normal(size=v.shape) * 0.1 for k, v in net.p.items()}
    x = rng.normal(size=(3, WINDOW, INPUTS))
    mask = (np.arange(WINDOW)[None, :] < np.array([[WINDOW], [5], [0]])).astype(float)
    x *= mask[:, :, None]
    weight = np.array([1.0, -2.0, 0.5])
    _, saved = net.forward(x, mask, keep=True)
    grads = net.gradients(weight, saved)
    for name, p in net.p.items():
        at = np.unravel_index(p.size // 2, p.shape)
        old, e = p[at], 1e-2
        p[at] = old + e
        up = net.forward(x, mask) @ weight
        p[at] = old - e
        down = net.forward(x, mask) @ weight
        p[at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * e), rel=0.05, abs=2e-3), name


def test_windows_cover_all_words():
    per = np.array([0, 1, 16, 17, 32, 33, 100, 48])
    text, first, size = windows(per)
    off = np.cumsum(per) - per
    for t, n in enumerate(per):
        k = text == t
        seen = {w for a, s in zip(first[k] - off[t], size[k], strict=True) for w in range(a, a + s)}
        assert seen == set(range(n)) and k.sum() >= 1


def test_one_toxic_window_in_a_long_text_counts():
    rng = np.random.default_rng(4)
    vocab = np.array([f"w{i}" for i in range(300)])
    make = lambda n, bad: " ".join(np.concatenate([rng.choice(vocab, n), ["vile", "scorn"][:2 * bad], rng.choice(vocab, n)]))
    y = (np.arange(400) % 4 == 0).astype(float)
    model = Scorer(*arrays([make(60, int(v)) for v in y]), y)
    long_bad, long_good = model.score(*arrays([make(5000, 1), make(5000, 0)]))[0]
    assert long_bad > 0.3 > long_good
    assert Words(*arrays(["Ab ab"])).hash.size == 1
