"""Packing documents into training sequences whose windows keep target token proportions.

Every source is a queue of documents laid end to end, and every window (a
sequence of ``length`` tokens) is filled by deficit round-robin: a queue's
credit grows with its weight as windows pass, what it was not served stays as
its deficit, and the next window serves the queues that are furthest behind
first, in grains of ``GRAIN`` tokens. Service is exact: grain k of a queue of
weight w falls due at the integer floor(k 2^80 / w), grains are served in the
order of (due, queue), and a window takes the next ``length / GRAIN`` of them.
So the state of the round-robin at any window, the deficits included, follows
from the window's number and the queues' sizes alone: tasks compute it where
they need it, deficits cross windows and partitions without messages, and any
task may be run again.

Steps: (1) tokens of every document, written with their place in the queue of
their task; (2) sums per task and queue give each task's place in the whole
queue; (3) each task cuts its documents at the windows' bounds. Token ids are
written once and never shuffled, unless there are so many tasks that Spark
deems their sums too large to broadcast.

A window holds ``length / GRAIN`` grains, so only a source with that share of
all bytes can have one grain in every window: such sources (at most as many as
a window has grains) get queues of their own, in the order of their names with
null last; the smaller ones share one queue in which they follow each other as
they come. The tokens beyond the last full grain of each queue come last. What
is left after the full windows is cut into sequences of powers of two, so no
sequence needs padding. Queues that run dry leave their share to the others.

Rules: a null text is empty, an empty text has the end token alone; rows with
equal or null ids are documents of their own; an empty table gives no pieces.
Equal splits of equal input give equal pieces.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from obsflow.llm.common import stash, text_slices

LENGTH, GRAIN, END_ID = 4096, 64, 2
#: Bytes that are split at a time; cached words (and matches) of a worker.
_BYTES, _CACHED = 4 << 20, 400_000
_DUE_BITS = 80
#: Fixed value: the pattern of a tokenizer whose texts can be encoded word by word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of ASCII signs and Latin letters; Latin-1 to lower case; the matches of the pattern in such words, and the blanks between.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]*$"
_LOWER = bytes(x + 32 if 0x41 <= x <= 0x5A or 0xC0 <= x <= 0xDE and x != 0xD7 else x for x in range(256))
_MATCHES = re.compile(rb"'(?:[stmd]|re|ve|ll)|[a-z\xDF-\xFF]+|[0-9]|[!-/:-@\[-`{-~]+| ").findall


class _Words(dict):
    """Ids of words, made by ``make`` where missing and kept while there is room."""

    def __init__(self, make, longest: int):
        super().__init__()
        self.make, self.longest = make, longest

    def __missing__(self, word):
        got = self.make(word)
        if len(self) < _CACHED and len(word) < self.longest:
            self[word] = got
        return got


def _joined(words: pa.StringArray) -> bytes:
    """The words with a blank after each."""
    words = pa.concat_arrays([words.view(pa.binary()), pa.array([b""], pa.binary())])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py()


@cache
def _packing(layout: str):
    return struct.Struct(layout).pack


class Encoder:
    """Token ids of a text as packed integers, by the tokenizer file at ``path``.

    Where the file's tokenizer drops blanks and takes runs of letters, single
    digits and runs of other signs, the different words between blanks of many
    texts are encoded once. Those of ASCII signs and Latin letters are cut into
    these runs, which go straight to the file's model, with a bounded cache; the
    others are likewise cached. Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.type = "<u2" if max(self.tokenizer.get_vocab_size() - 1, end_id) < (1 << 16) - 1 else "<u4"
        self.end = self._packed([end_id])
        self.by_word = self._splits_words(spec)
        if self.by_word:
            self.words, self.parts = _Words(self._ids, 64), _Words(self._part, 64)
            self.tokenize = self.tokenizer.model.tokenize
            self.between = int(np.iinfo(self.type).max)   # no id: stands after each word
            self.parts[b" "] = self._packed([self.between])
            self.named = [t["content"] for t in spec.get("added_tokens") or []]
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.byte_level = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))}

    @staticmethod
    def _splits_words(spec: dict) -> bool:
        """Whether the words match ``WORD_PATTERN``, all else is dropped, and only case and form of letters are normalised."""
        flat = lambda x, key: x.get(key, [x]) if x else []
        norm = [n["type"] for n in flat(spec.get("normalizer"), "normalizers")]
        pre = flat(spec.get("pre_tokenizer"), "pretokenizers")
        if norm != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] \
                or spec.get("post_processor") or spec["model"]["type"] != "BPE":
            return False
        split, level = pre
        return (split["pattern"].get("Regex") == WORD_PATTERN and split["behavior"] == "Removed" and split["invert"]
                and not level["add_prefix_space"] and not level["use_regex"]
                and not any(regex.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"]
                            for t in spec.get("added_tokens") or []))

    def _packed(self, ids: list[int]) -> bytes:
        return _packing(f"<{len(ids)}{'H' if self.type == '<u2' else 'I'}")(*ids)

    def _ids(self, data: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(data.decode(), add_special_tokens=False).ids)

    def _part(self, part: bytes) -> bytes:
        """Ids of a match, in Latin-1 and lower case."""
        text = part.decode("latin-1")
        return self._packed([t.id for t in self.tokenize(text if part.isascii() else text.translate(self.byte_level))])

    def _of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, number): the ids of words, and where those of each word are."""
        plain = pc.match_substring_regex(words, _PLAIN)
        for n in self.named:
            plain = pc.and_not(plain, pc.match_substring(words, n, ignore_case=True))
        text, odd = (_joined(words.filter(m)) for m in (plain, pc.invert(plain)))
        if not text.isascii():
            text = text.decode().encode("latin-1")
        ids = [*map(self.parts.__getitem__, _MATCHES(text.translate(_LOWER)))]
        for w in odd.split():
            ids += self.words[w], self.parts[b" "]
        ids = np.frombuffer(b"".join(ids), dtype=self.type)
        plain = plain.to_numpy(zero_copy_only=False)
        first, n = np.empty(len(words), dtype=np.int64), np.empty(len(words), dtype=np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        ends = np.flatnonzero(ids == self.between)
        first[order] = np.concatenate([[0], ends[:-1] + 1])[:len(words)]
        n[order] = ends - first[order]
        return ids, first, n

    def _texts(self, texts: pa.BinaryArray) -> list[bytes]:
        """Ids per text, those of every different word looked up once."""
        words = pc.ascii_split_whitespace(texts.view(pa.string()))
        coded = words.flatten().dictionary_encode()
        ids, first, n = self._of_words(coded.dictionary)
        which = coded.indices.to_numpy()
        first, n = first[which], n[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        tokens = ids[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]
        cut = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        return [tokens[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def many(self, texts: pa.BinaryArray) -> list[bytes]:
        """``__call__`` of every text (null is empty); of at most ``_BYTES`` in all, or one by one."""
        texts = texts.fill_null(b"")
        if self.by_word and (pc.sum(pc.binary_length(texts)).as_py() or 0) <= _BYTES:
            return [ids + self.end for ids in self._texts(texts)]
        return [self(text.as_py()) for text in texts]

    def __call__(self, data: bytes) -> bytes:
        """The ids of a UTF-8 text and the end token after them."""
        if not self.by_word:
            return self._ids(data) + self.end
        out, a = [], 0
        while a < len(data):
            b = len(data)
            if b - a > _BYTES:
                at = data.find(b" ", a + _BYTES)
                b = at if at >= 0 else b
            out += self._texts(pa.array([data[a:b]], pa.binary()))
            a = b
        return b"".join(out) + self.end


class RoundRobin:
    """The service order of queues of full grains: the state at any window, from its number alone."""

    def __init__(self, sizes: list[int], weights: list[int] | None = None, length: int = LENGTH, grain: int = GRAIN):
        self.length, self.grain, self.per_window = length, grain, length // grain
        self.grains = [s // grain for s in sizes]
        self.tails = [s % grain for s in sizes]
        self.weights = [max(1, w) for w in (weights or self.grains)]
        self.total = sum(self.grains)
        self.tokens = sum(sizes)
        self.full = self.tokens // length
        # sequences of powers of two for what is left after the full windows
        rest, at, self.ends = self.tokens % length, self.full * length, []
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                at += 1 << bit
                self.ends.append(at)
        # where queues run dry: the due time, grains served by then
        dry = sorted((self._due(q, n), q) for q, n in enumerate(self.grains) if n)
        self.dry_due = [d for d, _ in dry]
        self.dry_served = [sum(self._served(t, d) for t in range(len(sizes))) for d, _ in dry]
        self.dry_grains, self.dry_weight = [0], [sum(w for w, n in zip(self.weights, self.grains, strict=True) if n)]
        for _, q in dry:
            self.dry_grains.append(self.dry_grains[-1] + self.grains[q])
            self.dry_weight.append(self.dry_weight[-1] - self.weights[q])
        self._cuts: dict[int, list[int]] = {}

    def _due(self, q: int, k: int) -> int:
        return (k << _DUE_BITS) // self.weights[q]

    def _served(self, q: int, due: int) -> int:
        """Grains of queue ``q`` that fall due at ``due`` or before."""
        return min(self.grains[q], ((due + 1) * self.weights[q] - 1) >> _DUE_BITS)

    def cut(self, w: int) -> list[int]:
        """Grains of each queue served before window ``w``."""
        got = self._cuts.get(w)
        if got is not None:
            return got
        want = min(w * self.per_window, self.total)
        phase = bisect_right(self.dry_served, want)
        if want == self.total:
            got = list(self.grains)
        else:
            # credits alone: what every queue is owed in full by then, and at most ``want`` grains in all
            due = max(-1, ((want - self.dry_grains[phase]) << _DUE_BITS) // self.dry_weight[phase] - 1)
            got = [self._served(q, due) for q in range(len(self.grains))]
            left = want - sum(got)
            heap = [(self._due(q, c + 1), q) for q, c in enumerate(got) if c < self.grains[q]]
            heapq.heapify(heap)
            for _ in range(left):  # the largest deficits first: fewer rounds than queues
                _, q = heap[0]
                got[q] += 1
                if got[q] < self.grains[q]:
                    heapq.heapreplace(heap, (self._due(q, got[q] + 1), q))
                else:
                    heapq.heappop(heap)
        if len(self._cuts) >= 4096:
            self._cuts.clear()
        self._cuts[w] = got
        return got

    def window(self, q: int, g: int) -> int:
        """The window that serves grain ``g`` of queue ``q``."""
        due = self._due(q, g + 1)
        before = g + sum(self._served(t, due if t < q else due - 1) for t in range(len(self.grains)) if t != q)
        return before // self.per_window

    def runs(self, q: int, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """(from, to, place): tokens ``a`` to ``b`` of queue ``q`` in runs, with the place of each in the whole packing."""
        end = self.grains[q] * self.grain
        w = self.window(q, a // self.grain) if a < min(b, end) else 0
        while a < min(b, end):
            lo, hi = self.cut(w), self.cut(w + 1)
            stop = min(b, end, hi[q] * self.grain)
            if stop > a:
                ahead = sum(hi[:q]) - sum(lo[:q])
                yield a, stop, w * self.length + (ahead - lo[q]) * self.grain + a
                a = stop
            if a < min(b, end):
                w = w + 1 if self.cut(w + 2)[q] * self.grain > a else self.window(q, a // self.grain)
        if a < b:
            yield a, b, self.total * self.grain + sum(self.tails[:q]) + a - end

    def pieces(self, q: int, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
        """(from, to, sequence, offset): the runs cut at the ends of sequences."""
        for lo, hi, at in self.runs(q, a, b):
            while lo < hi:
                if at < self.full * self.length:
                    seq, start = divmod(at, self.length)
                    stop, start = (seq + 1) * self.length, at - start
                else:
                    k = bisect_right(self.ends, at)
                    seq, stop = self.full + k, self.ends[k]
                    start = self.ends[k - 1] if k else self.full * self.length
                n = min(hi - lo, stop - at)
                yield lo, lo + n, seq, at - start
                lo, at = lo + n, at + n


def own_queues(docs: DataFrame, text_col: str, source_col: str, most: int) -> list[str | None]:
    """The sources with at least one ``most``-th of all bytes, by name with null last: at most ``most`` of them."""
    sizes = stash(docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(
        F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).alias("bytes")), "packing-sources")
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("t")).first()["t"]
    big = [r["source"] for r in sizes.where(F.col("bytes") * most >= F.lit(total)).select("source").collect()]
    return sorted(big, key=lambda s: (s is None, s or ""))


def _queue(source, names: list[str | None]):
    named = [x for k, s in enumerate(names) if s is not None for x in (F.lit(s), F.lit(k))]
    at = F.element_at(F.create_map(*named), source) if named else F.lit(None).cast("int")
    null = next((k for k, s in enumerate(names) if s is None), len(names))
    return F.when(source.isNull(), F.lit(null)).otherwise(F.coalesce(at, F.lit(len(names)))).cast("int")


_encoders: dict[tuple[str, int], Encoder] = {}  # of this worker: its caches serve all its tasks


def _tokenizing(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get((path, end_id)) or _encoders.setdefault((path, end_id), Encoder(path, end_id))
        width = np.dtype(encode.type).itemsize
        task, at = TaskContext.get().partitionId(), {}
        for batch in text_slices(batches, "data", _BYTES):
            ids, place = encode.many(batch.column(2)), []
            n = [len(x) // width for x in ids]
            for q, k in zip(batch.column(1).to_pylist(), n, strict=True):
                place.append(at.get(q, 0))
                at[q] = place[-1] + k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([task] * len(n), pa.int32()), batch.column(1), pa.array(place, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc", "task", "queue", "place", "n", "ids"])
    return run


def _cutting(robin: RoundRobin, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cols, ids, held = [], [], [], 0
            for i, (q, at, raw) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                                 batch.column(3), strict=True)):
                tokens = np.frombuffer(raw.as_py(), dtype=f"<u{width}").astype("<u4")
                for lo, hi, seq, off in robin.pieces(q, at, at + len(tokens)):
                    row.append(i)
                    cols.append((lo - at, hi - lo, len(tokens), seq, off))
                    ids.append(tokens[lo - at:hi - at].tobytes())
                    held += len(ids[-1])
                if row and (held > 4 << 20 or i == batch.num_rows - 1):
                    start, n, doc, seq, off = (pa.array(c, pa.int64()) for c in zip(*cols, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), start, n, pa.array(ids, pa.binary()),
                                                      doc, seq, off],
                                                     ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                    row, cols, ids, held = [], [], [], 0
    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, grain: int = GRAIN, end_id: int = END_ID,
         weights: dict[str | None, int] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """(``id_col``, start, length, ids, doc_tokens, sequence_id, offset): one row per piece of a document.

    ``ids`` are little-endian unsigned 32-bit token ids. ``weights`` are the
    target proportions of sources with a queue of their own (1 where a source
    is not named; the shared queue has weight 1); without them every window has
    the proportions of the whole table.
    """
    if length % grain or length & (length - 1):
        raise ValueError("length must be a power of two and a multiple of grain")
    names = own_queues(docs, text_col, source_col, length // grain)
    queue = _queue(F.col(source_col).cast("string"), names)
    source = docs.select(F.col(id_col).alias("doc"), queue.alias("queue"), F.col(text_col).cast("binary").alias("data"))
    doc = StructField("doc", source.schema["doc"].dataType)
    tokens = StructType([doc, StructField("task", IntegerType()), StructField("queue", IntegerType()),
                         StructField("place", LongType()), StructField("n", LongType()), StructField("ids", BinaryType())])
    tokens = stash(source.mapInArrow(_tokenizing(tokenizer_path, end_id), tokens), "packing-tokens")
    sums = tokens.groupBy("task", "queue").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = stash(sums.select(F.col("task").alias("t"), F.col("queue").alias("q"), "n",
                             F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "packing-bases")
    sizes = [0] * (len(names) + 1)
    for r in base.groupBy("q").agg(F.sum("n").alias("n")).collect():  # one row per queue
        sizes[r["q"]] = r["n"]
    share = None if weights is None else [weights.get(s, 1) for s in names] + [1]
    robin = RoundRobin(sizes, share, length, grain)
    width = np.dtype(Encoder(tokenizer_path, end_id).type).itemsize
    out = StructType([doc] + [StructField(c, BinaryType() if c == "ids" else LongType())
                              for c in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")])
    placed = tokens.join(base, (F.col("task") == F.col("t")) & (F.col("queue") == F.col("q")))
    return (placed.select("doc", "queue", F.col("base") + F.col("place"), "ids").mapInArrow(_cutting(robin, width), out)
            .withColumnRenamed("doc", id_col))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences; at most ``length`` tokens meet in a group."""
    got = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return got.select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
