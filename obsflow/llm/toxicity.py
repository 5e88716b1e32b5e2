"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Every word carries word inputs (how much more often the training documents that
hold it are toxic, and how well that is known) and character inputs (the same
for the byte trigrams of its spelling, which also speak for unseen words). The
network reads windows of 32 words that overlap by half; a document's score is
the calibrated logit of its worst window.

Training sees documents, not windows, with a label: toxic documents are taught
through their currently worst window, the others through their worst and a
random one. Evidence of a training document is counted without the document
itself.

Rules: null text is empty; a text without words is one empty window; rows with
a null label teach nothing; without both classes the score is the (smoothed)
share of toxic rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.llm.common import text_slices, utf8
from obsflow.llm.quality import fold
from obsflow.llm.words import ALNUM, VALUE_FOLDED, find_words, hash_words, mix64

WINDOW, STRIDE, HIDDEN, INPUTS = 32, 16, 6, 4
TRIGRAMS = 1 << 15
#: The labelled rows a model is fitted on at most (smallest hash of the id), and their length in bytes.
FIT_ROWS, FIT_BYTES = 6_000, 32_768


class Words:
    """The words of a batch of texts: distinct words with their trigram buckets, and where each occurs."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        start, end, self.per = find_words(data, off, ALNUM)
        h = hash_words(data, start, end)
        self.hash, first, self.at = np.unique(h, return_index=True, return_inverse=True)
        a, size = start[first], end[first] - start[first]
        # trigrams of the word between two boundary bytes: as many as it has bytes
        self.owner = np.repeat(np.arange(len(a)), size)
        pos = np.arange(len(self.owner)) - np.repeat(np.cumsum(size) - size, size)
        value = VALUE_FOLDED
        here = value[data[a[self.owner] + pos]]
        left = np.where(pos > 0, np.roll(here, 1), value[32]) if len(here) else here
        right = np.where(pos < size[self.owner] - 1, np.roll(here, -1), value[32]) if len(here) else here
        mixed = mix64(mix64(left) * np.uint64(3) + mix64(here) * np.uint64(5) + mix64(right) * np.uint64(7))
        self.gram = (mixed % np.uint64(TRIGRAMS)).astype(np.int64)


def _evidence(toxic: np.ndarray, seen: np.ndarray, prior: float, strength: float = 4.0) -> np.ndarray:
    """Shrunken log odds of toxicity against the prior."""
    p = (toxic + strength * prior) / (seen + strength)
    return (np.log(p / (1 - p)) - np.log(prior / (1 - prior))).astype(np.float32)


class Lexicon:
    """Counts per word and per trigram of the training documents that hold it, and of the toxic ones."""

    def __init__(self, words: Words, y: np.ndarray):
        self.prior = float((y.sum() + 0.5) / (len(y) + 1))
        doc = np.repeat(np.arange(len(y)), words.per)
        pair = np.unique(doc * len(words.hash) + words.at)
        d, w = pair // max(1, len(words.hash)), pair % max(1, len(words.hash))
        self.hash = words.hash
        self.seen = np.bincount(w, minlength=len(words.hash))
        self.toxic = np.bincount(w, y[d], len(words.hash))
        # a trigram counts once per distinct word and document that hold it
        g, o = words.gram, words.owner
        self.gram_seen = np.bincount(g, self.seen[o], TRIGRAMS)
        self.gram_toxic = np.bincount(g, self.toxic[o], TRIGRAMS)
        self.pack()

    def pack(self) -> None:
        common = self.seen >= 2  # what one document holds says nothing
        self.hash, self.seen, self.toxic = self.hash[common], self.seen[common], self.toxic[common]

    def inputs(self, words: Words, own: np.ndarray | None = None) -> np.ndarray:
        """(distinct word x INPUTS), or (occurrence x INPUTS) without the evidence of the own document's label."""
        known = np.zeros(len(words.hash), dtype=bool)
        at = np.zeros(len(words.hash), dtype=np.int64)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
            known = self.hash[at] == words.hash
        seen = np.where(known, self.seen[at] if len(self.hash) else 0, 0)
        toxic = np.where(known, self.toxic[at] if len(self.hash) else 0, 0)
        size = np.maximum(np.bincount(words.owner, minlength=len(words.hash)), 1)
        gram = _evidence(self.gram_toxic, self.gram_seen, self.prior, 20.0)[words.gram]
        mean = np.bincount(words.owner, gram, len(words.hash)) / size
        low = np.zeros(len(words.hash), dtype=np.float32)
        np.maximum.at(low, words.owner, gram)
        if own is not None:
            label = np.repeat(own, words.per)
            seen = np.maximum(seen[words.at] - 1, 0)
            toxic = np.clip(toxic[words.at] - label, 0, seen)
            mean, low = mean[words.at], low[words.at]
        return np.stack([_evidence(toxic, seen, self.prior), np.minimum(np.log1p(seen) / 4, 1.5), mean, low],
                        axis=1).astype(np.float32)


def windows(per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, length) of all overlapping windows; the last one of a text ends with it."""
    off = np.cumsum(per) - per
    many = np.maximum(1, -(-(per - STRIDE) // STRIDE))
    text = np.repeat(np.arange(len(per)), many)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    return text, off[text] + first, np.clip(per[text] - first, 0, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Two gated recurrent layers (forward, backward), attention over their joined states, one logit."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"wx{d}": draw(INPUTS, 3 * HIDDEN), f"wh{d}": draw(HIDDEN, 3 * HIDDEN),
                       f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"att": draw(2 * HIDDEN, 1), "out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}

    def _layer(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States per step (window, step, HIDDEN); what the backward pass needs if ``keep``."""
        n, steps, _ = x.shape
        h, hid = np.zeros((n, HIDDEN), np.float32), HIDDEN
        pre = x.reshape(-1, INPUTS) @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        pre = pre.reshape(n, steps, 3 * hid)
        wh = self.p[f"wh{d}"]
        states, tape = np.empty((n, steps, hid), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            rec = h @ wh
            gates = _sigmoid(pre[:, t, :2 * hid] + rec[:, :2 * hid])
            z, r = gates[:, :hid], gates[:, hid:]
            new = np.tanh(pre[:, t, 2 * hid:] + r * rec[:, 2 * hid:])
            m = mask[:, t, None]
            nxt = h + m * (1 - z) * (new - h)
            if keep:
                tape.append((t, h, z, r, new, rec[:, 2 * hid:], m))
            h = nxt
            states[:, t] = h
        return states, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        sf, tf = self._layer("f", x, mask, keep)
        sb, tb = self._layer("b", x, mask, keep)
        s = np.concatenate([sf, sb], axis=2)
        e = (s.reshape(-1, 2 * HIDDEN) @ self.p["att"]).reshape(mask.shape)
        e = np.where(mask > 0, e, -1e9)
        a = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        pooled = (a[:, None, :] @ s)[:, 0]
        logit = (pooled @ self.p["out"])[:, 0] + self.p["bias"][0]
        return (logit, (x, mask, s, a, pooled, tf, tb)) if keep else logit

    def gradients(self, g_logit: np.ndarray, saved) -> dict[str, np.ndarray]:
        x, mask, s, a, pooled, tf, tb = saved
        g = {"bias": np.array([g_logit.sum()], np.float32), "out": pooled.T @ g_logit[:, None]}
        g_pooled = g_logit[:, None] * self.p["out"][:, 0]
        g_a = (s @ g_pooled[:, :, None])[:, :, 0]
        g_e = a * (g_a - (a * g_a).sum(axis=1, keepdims=True))
        g["att"] = s.reshape(-1, 2 * HIDDEN).T @ g_e.reshape(-1, 1)
        g_s = a[:, :, None] * g_pooled[:, None, :] + g_e[:, :, None] * self.p["att"][:, 0]
        for d, tape, part in (("f", tf, g_s[:, :, :HIDDEN]), ("b", tb, g_s[:, :, HIDDEN:])):
            wh = self.p[f"wh{d}"]
            g_pre = np.zeros((*mask.shape, 3 * HIDDEN), np.float32)
            g_wh, g_h = np.zeros_like(wh), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, z, r, new, rec, m in reversed(tape):
                g_h = g_h + part[:, t]
                g_new = g_h * m * (1 - z) * (1 - new ** 2)
                g_z = -g_h * m * (new - h) * z * (1 - z)
                g_r = g_new * rec * r * (1 - r)
                g_pre[:, t] = np.concatenate([g_z, g_r, g_new], axis=1)
                g_rec = np.concatenate([g_z, g_r, g_new * r], axis=1)
                g_wh += h.T @ g_rec
                g_h = g_h * (1 - m * (1 - z)) + g_rec @ wh.T
            flat = g_pre.reshape(-1, 3 * HIDDEN)
            g |= {f"wh{d}": g_wh, f"wx{d}": x.reshape(-1, INPUTS).T @ flat, f"b{d}": flat.sum(axis=0)}
        return g


def _gather(inputs: np.ndarray, row: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, WINDOW, INPUTS) and the mask; ``row`` indexes ``inputs`` per window and step."""
    mask = (np.arange(WINDOW)[None, :] < size[:, None]).astype(np.float32)
    return inputs[row] * mask[:, :, None], mask


class Scorer:
    """Lexicon, network and calibration; fitted on a bounded sample, applied to any batch of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, y: np.ndarray, rounds: int = 3, epochs: int = 3):
        self.net, self.scale, self.shift = Network(), 1.0, 0.0
        self.constant = None
        if y.min(initial=1) == y.max(initial=0):
            self.constant = float((y.sum() + 0.1) / (len(y) + 1))
            return
        rng = np.random.default_rng(9)
        words = Words(data, off)
        self.lexicon = Lexicon(words, y)
        x = self.lexicon.inputs(words, y)
        text, first, size = windows(words.per)
        last = max(len(x) - 1, 0)
        rows = lambda k: np.minimum(first[k][:, None] + np.arange(WINDOW), last)
        strong = np.concatenate([[0], np.cumsum(np.maximum(x[:, 0], 0), dtype=np.float64)])
        rank = strong[np.minimum(first + size, len(x))] - strong[np.minimum(first, len(x))]
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.net.p.items()}
        step = 0
        for _ in range(rounds):
            worst = self._worst(text, rank, len(y))
            clean = np.flatnonzero(y == 0)
            lo = np.searchsorted(text, clean)
            hi = np.searchsorted(text, clean, "right")
            pick = np.concatenate([worst, lo + (rng.random(len(clean)) * (hi - lo)).astype(np.int64)])
            label = y[text[pick]].astype(np.float32)
            for _ in range(epochs):
                order = rng.permutation(len(pick))
                for a in range(0, len(order), 256):
                    k = order[a:a + 256]
                    logit, saved = self.net.forward(*_gather(x, rows(pick[k]), size[pick[k]]), keep=True)
                    grads = self.net.gradients(((_sigmoid(logit) - label[k]) / len(k)).astype(np.float32), saved)
                    step += 1
                    for name, g in grads.items():
                        m, v = state[name]
                        m += 0.1 * (g - m)
                        v += 0.01 * (g ** 2 - v)
                        rate = 0.02 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                        self.net.p[name] -= rate * m / (np.sqrt(v) + 1e-7)
            rank = self._logits(x, lambda k: rows(k), size)
        top = np.maximum.reduceat(rank, np.searchsorted(text, np.arange(len(y))))
        self._calibrate(top, y)

    @staticmethod
    def _worst(text: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
        order = np.lexsort((rank, text))
        return order[np.searchsorted(text, np.arange(n), "right") - 1]

    def _logits(self, x: np.ndarray, rows, size: np.ndarray) -> np.ndarray:
        out = np.empty(len(size), dtype=np.float32)
        for a in range(0, len(size), 4096):
            k = np.arange(a, min(a + 4096, len(size)))
            out[k] = self.net.forward(*_gather(x, rows(k), size[k]))
        return out

    def _calibrate(self, top: np.ndarray, y: np.ndarray, steps: int = 50) -> None:
        """Logistic regression of the label on the worst window's logit (Newton steps, lightly held)."""
        w = np.array([1.0, 0.0])
        z = np.stack([top.astype(np.float64), np.ones(len(top))], axis=1)
        for _ in range(steps):
            p = _sigmoid(z @ w)
            g = z.T @ (y - p) - 0.1 * (w - [1.0, 0.0])
            h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2)
            w = w + np.linalg.solve(h, g)
        self.scale, self.shift = max(float(w[0]), 0.05), float(w[1])

    def score(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its score, its number of windows and the first word of its worst window."""
        if self.constant is not None:
            n = len(off) - 1
            return np.full(n, self.constant), np.zeros(n, np.int64), np.zeros(n, np.int64)
        words = Words(data, off)
        x = np.concatenate([self.lexicon.inputs(words), np.zeros((1, INPUTS), np.float32)])
        at = np.concatenate([words.at, [len(x) - 1]])
        text, first, size = windows(words.per)
        logits = self._logits(x, lambda k: at[np.minimum(first[k][:, None] + np.arange(WINDOW), len(at) - 1)], size)
        head = np.searchsorted(text, np.arange(len(off)))
        top = np.maximum.reduceat(logits, head[:-1])
        worst = self._worst(text, logits, len(off) - 1)
        return (_sigmoid(self.scale * top.astype(np.float64) + self.shift), np.diff(head),
                first[worst] - (np.cumsum(words.per) - words.per))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample, in one partition, to a pickled model (one row)."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        data, off = utf8(table.column(0))
        scorer = Scorer(data, off, table.column(1).to_numpy().astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(scorer)], pa.binary())], ["model"])


def toxicity_scores(docs: DataFrame, labelled: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2,
                    threshold: float = 0.3, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES, carry: bool = False,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score, n_windows, worst_word, held_out, predicted) per row of ``docs``.

    ``carry`` keeps all columns of ``docs``, but for those with a name of the result.

    ``labelled`` are the documents that ``labels`` speaks of. The model is
    fitted on the ``fit_rows`` labels outside the held fold with the smallest
    hash of their id at most, among those whose text has up to ``fit_bytes`` bytes.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where("y in (0, 1)")
             .where(~fold(F.col("i"), folds, held)))
    text = labelled.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = text.where(F.octet_length("text") <= fit_bytes)
    # at most fit_rows ids, so they can be broadcast and no text is shuffled
    chosen = (known.join(text.select("i"), "i", "left_semi").withColumn("o", F.xxhash64("i"))
              .orderBy("o", "i", "y").limit(fit_rows))
    sample = (text.join(F.broadcast(chosen), "i")
              .orderBy("o", "i", "y", F.xxhash64("text")).limit(fit_rows).select("text", "y"))
    # one task holds the bounded sample and fits; the driver only passes the small model on
    fitted = sample.mapInArrow(_fit, "model binary").first()
    model = spark.sparkContext.broadcast(fitted["model"] if fitted else pickle.dumps(Scorer(*utf8(pa.array([], pa.string())),
                                                                                           np.zeros(0))))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = pickle.loads(model.value)
        for batch in text_slices(batches, text_col):
            found = [pa.array(x) for x in scorer.score(*utf8(batch.column(at)))]
            columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name in carried]
            yield pa.RecordBatch.from_arrays(columns + found, schema.names)

    own = {"score", "n_windows", "worst_word", "held_out", "predicted"}
    carried = [c for c in docs.columns if c == id_col or (carry and c.lower() not in own)]
    added = StructType.fromDDL("score double, n_windows long, worst_word long")
    schema = StructType([docs.schema[c] for c in carried] + added.fields)
    return (docs.mapInArrow(run, schema).withColumn("held_out", fold(F.col(id_col), folds, held))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
