"""op1 and op8 against plain loops: features, table sums, lexicon counts and the network, one text and window at a time."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsflow.llm.common import utf8
from obsflow.llm.quality import FEATURES, AdditiveModel
from obsflow.llm.queries import op1_quality, op8_toxicity
from obsflow.llm.toxicity import FIT_BYTES, TRIGRAMS, Scorer
from obsflow.llm.words import VALUE_FOLDED, mix64
from tests.conftest import SF001, SF01


def fit_sample(spark, folder, label, folds, held, most=None):
    """(id, text, y) of the labelled rows outside the held fold, in the order of the fit."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col(label).alias("y")).where("y in (0, 1)")
    rows = (docs.join(known, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held)
            .orderBy(F.xxhash64("doc_id"), "doc_id", "y", F.xxhash64("text")).collect())
    return [r for r in rows if most is None or len(r.text.encode()) <= most]


def fold_ascii(raw):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in raw)


def features(text):
    raw = (text or "").encode()
    words = [w for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    lines = [x for x in raw.split(b"\n") if x]
    low = [fold_ascii(w) for w in words]
    n, per, lined = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    count = lambda members: sum(raw.count(bytes([c])) for c in members)
    groups = {"blanks": b" \t\n\x0b\x0c\r", "pipes": b"|", "marks": b"!?", "stops": b".", "commas": b",;:'\"-", "brackets": b"()[]{}<>/\\="}
    upper, lower = sum(65 <= c <= 90 for c in raw), sum(97 <= c <= 122 for c in raw)
    digit, beyond = sum(48 <= c <= 57 for c in raw), sum(c >= 128 for c in raw)
    part = {k: count(v) for k, v in groups.items()}
    plain = lambda c: (65 <= c <= 90 or 97 <= c <= 122 or 48 <= c <= 57 or c >= 128
                       or any(c in groups[k] for k in ("blanks", "stops", "commas")))
    found = {
        "log_bytes": np.log1p(len(raw)), "log_words": np.log1p(len(words)), "word_bytes": sum(map(len, words)) / per,
        "longest_word": np.log1p(max(map(len, words), default=0)), "short_words": sum(len(w) == 1 for w in words) / per,
        "upper": upper / max(upper + lower, 1), "digits": digit / n, "beyond_ascii": beyond / n,
        **{k: v / n for k, v in part.items()},
        "other_symbols": (len(raw) - upper - lower - digit - beyond - sum(part.values())) / n,
        "distinct_words": len(set(low)) / per, "top_word": max(Counter(low).values(), default=0) / per,
        "repeats": sum(a == b for a, b in zip(low[1:], low[:-1], strict=True)) / per, "log_lines": np.log1p(len(lines)),
        "distinct_lines": len(set(map(fold_ascii, lines))) / lined, "words_a_line": len(words) / lined,
        "symbol_ends": sum(not plain(w[-1]) for w in words) / per,
        "caps_words": sum(65 <= w[0] <= 90 and len(w) > 1 for w in words) / per,
    }
    return np.array([found[f] for f in FEATURES], dtype=np.float32)


def test_op1_against_table_sums(spark):
    taught = fit_sample(spark, SF01, "quality", 5, 0)
    model = AdditiveModel(np.stack([features(r.text) for r in taught]), np.array([float(r.y) for r in taught]))
    assert len(model.pairs) > 0
    text = dict(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect())
    got = op1_quality(spark, SF01).collect()
    assert len(got) == len(text)
    for r in got:
        x = features(text[r.doc_id])
        at = [sum(1 for e in model.edges[f] if e <= x[f]) for f in range(len(FEATURES))]
        total = model.base + sum(model.tables[f][at[f]] for f in range(len(FEATURES)))
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[at[i] * len(table) // len(model.tables[i])][at[j] * len(table) // len(model.tables[j])]
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)
        assert r.predicted == int(r.score >= 0.3)


def words_of(text):
    return [fold_ascii(w) for w in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())]


def grams(word):
    """The trigram buckets of a word between two blanks."""
    v = [VALUE_FOLDED[32], *(VALUE_FOLDED[c] for c in word), VALUE_FOLDED[32]]
    mixed = [int(mix64(np.array([x]))[0]) for x in v]
    whole = [(mixed[i - 1] * 3 + mixed[i] * 5 + mixed[i + 1] * 7) % 2 ** 64 for i in range(1, len(v) - 1)]
    return [int(mix64(np.array([t], dtype=np.uint64))[0]) % TRIGRAMS for t in whole]


def evidence(toxic, seen, prior, strength):
    p = (toxic + strength * prior) / (seen + strength)
    return math.log(p / (1 - p)) - math.log(prior / (1 - prior))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def states(steps, wx, wh, b):
    """States of a gated recurrent layer, step by step."""
    k = wh.shape[0]
    h, out = np.zeros(k), []
    for x in steps:
        a, rec = x @ wx + b, h @ wh
        z, r = sigmoid(a[:k] + rec[:k]), sigmoid(a[k:2 * k] + rec[k:2 * k])
        h = z * h + (1 - z) * np.tanh(a[2 * k:] + r * rec[2 * k:])
        out.append(h)
    return out


def test_op8_against_one_window_at_a_time(spark):
    taught = fit_sample(spark, SF001, "toxic", 4, 2, FIT_BYTES)
    y = np.array([float(r.y) for r in taught])
    model = Scorer(*utf8(pa.array([r.text for r in taught], pa.string())), y)
    assert model.constant is None
    p = {k: v.astype(np.float64) for k, v in model.net.p.items()}
    prior = (y.sum() + 0.5) / (len(y) + 1)
    seen, toxic = Counter(), Counter()
    for r in taught:
        for w in set(words_of(r.text)):
            seen[w] += 1
            toxic[w] += r.y
    gram_seen, gram_toxic, of = Counter(), Counter(), {}
    for w in seen:
        of[w] = grams(w)
        for g in of[w]:
            gram_seen[g] += seen[w]
            gram_toxic[g] += toxic[w]
    known = {}

    def inputs(w):
        if w not in known:
            n, t = (seen[w], toxic[w]) if seen[w] >= 2 else (0, 0)
            odds = [evidence(gram_toxic[g], gram_seen[g], prior, 20.0) for g in of.get(w) or grams(w)]
            known[w] = np.array([evidence(t, n, prior, 4.0), min(math.log1p(n) / 4, 1.5), sum(odds) / len(odds), max(0.0, *odds)])
        return known[w]

    def logit(window):
        steps = [inputs(w) for w in window]
        ahead = states(steps, p["wxf"], p["whf"], p["bf"])
        back = states(steps[::-1], p["wxb"], p["whb"], p["bb"])[::-1]
        both = [np.concatenate(s) for s in zip(ahead, back, strict=True)]
        weight = np.array([math.exp(float((s @ p["att"])[0])) for s in both])
        pooled = sum(a * s for a, s in zip(weight / weight.sum(), both, strict=True)) if both else np.zeros(len(p["out"]))
        return float((pooled @ p["out"])[0] + p["bias"][0])

    text = dict(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    got = op8_toxicity(spark, SF001).collect()
    assert len(got) == len(text)
    for r in got:
        words = words_of(text[r.doc_id])
        cut = [words[a:a + 32] for a in range(0, max(len(words) - 16, 1), 16)]
        want = float(sigmoid(model.scale * max(map(logit, cut)) + model.shift))
        assert r.n_windows == len(cut) and r.score == pytest.approx(want, abs=1e-4)
        assert r.predicted == int(r.score >= 0.3)
