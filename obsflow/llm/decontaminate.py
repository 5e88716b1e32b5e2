"""Benchmark decontamination by an FM-index per shard of the training text.

Test phrases are all windows of 13 words of the benchmark texts (the whole text
where it is shorter). Each shard (two megabytes of documents inside a task)
is indexed over its runs of benchmark words; the phrases are looked up by
backward search, occurrences located through sampled suffix positions, and the
covered words merged into spans. Documents are never shuffled. Phrases go out
in blocks of a bounded number, each a pass over the documents.

Rules: null text has no words; a benchmark row without words has no phrase; a
null item id counts as the item named by the empty string; rows with an equal
item id are one item; every row of the documents gets its own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import stash, text_slices, utf8
from obsflow.llm.fm_index import FMIndex
from obsflow.llm.words import ALNUM, find_words, hash_words

WINDOW = 13
#: A block of phrases holds about this many (13 hashes of 8 bytes each: 20 MB).
BLOCK_PHRASES = 200_000

#: A shard is as many whole documents as fit into this many bytes, one at least.
SHARD_BYTES = 2 << 20

_SPAN = pa.struct([("w0", pa.int64()), ("w1", pa.int64()), ("b0", pa.int64()), ("b1", pa.int64())])
_RESULT = "row_id long, th long, n_words long, spans array<struct<w0:long,w1:long,b0:long,b1:long>>, items array<string>"


def _phrases(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, off = utf8(batch.column(1))
            start, end, per = find_words(data, off, ALNUM)
            h = hash_words(data, start, end).view(np.int64)
            woff = np.concatenate([[0], np.cumsum(per)])
            items, rows = [], []
            for t, item in enumerate(batch.column(0).to_pylist()):
                a, b = woff[t], woff[t + 1]
                for i in range(a, max(a + (b > a), b - window + 1)):
                    items.append("" if item is None else str(item))
                    rows.append(h[i:min(b, i + window)].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(rows, pa.list_(pa.int64()))],
                                             ["item", "phrase"])
    return run


class PhraseBlock:
    """Distinct phrases of a block by length, as word ids of the block's own vocabulary, and their items."""

    def __init__(self, items: list[str], phrases: list[list[int]]):
        self.vocab = np.unique(np.array([w for p in phrases for w in p], dtype=np.int64).view(np.uint64))
        self.names = sorted(set(items))
        number = {x: i for i, x in enumerate(self.names)}
        by_len: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, p in zip(items, phrases, strict=True):
            by_len.setdefault(len(p), {}).setdefault(tuple(p), set()).add(number[item])
        self.groups = []
        for n, found in sorted(by_len.items()):
            words = np.array(list(found), dtype=np.int64).reshape(-1, n).view(np.uint64)
            owners = [sorted(x) for x in found.values()]
            self.groups.append((n, np.searchsorted(self.vocab, words) + 1,
                                np.concatenate([[0], np.cumsum([len(x) for x in owners])]),
                                np.array([i for x in owners for i in x], dtype=np.int64)))
        self.shortest = min(by_len, default=0)


def occurrences(block: PhraseBlock, h: np.ndarray, per: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(phrase length, word positions, items) of all phrase occurrences in a shard of word hashes."""
    if not len(h) or not len(block.vocab):
        return
    at = np.minimum(np.searchsorted(block.vocab, h), len(block.vocab) - 1)
    known = block.vocab[at] == h
    # runs of benchmark words inside a text, each as long as the shortest phrase, with a separator after each
    cut = np.zeros(len(h), dtype=bool)
    heads = (np.cumsum(per) - per)[per > 0]
    cut[heads] = True
    head = known & (cut | ~np.concatenate([[False], known[:-1]]))
    run = np.cumsum(head) - 1
    where = np.flatnonzero(known)
    if not len(where):
        return
    sizes = np.bincount(run[where])
    where = where[sizes[run[where]] >= block.shortest]
    if not len(where):
        return
    new_run = np.concatenate([[False], run[where][1:] != run[where][:-1]])
    place = np.arange(len(where)) + np.cumsum(new_run)
    sym = np.zeros(place[-1] + 2, dtype=np.int64)
    origin = np.zeros(place[-1] + 2, dtype=np.int64)
    sym[place], origin[place] = at[where] + 1, where
    index = FMIndex(sym, len(block.vocab) + 1)
    for n, phrases, off, owner in block.groups:
        which, lo, hi = index.search(phrases)
        if not len(which):
            continue
        count = hi - lo
        rows = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        pos = origin[index.locate(rows)]
        phrase = np.repeat(which, count)
        many = off[phrase + 1] - off[phrase]
        pick = np.repeat(off[phrase] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        yield n, np.repeat(pos, many), owner[pick]


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in text_slices(batches, "text", SHARD_BYTES):
            data, off = utf8(batch.column(2))
            start, end, per = find_words(data, off, ALNUM)
            woff = np.concatenate([[0], np.cumsum(per)])
            delta = np.zeros(len(start) + 1, dtype=np.int64)
            docs, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for n, pos, item in occurrences(block, hash_words(data, start, end), per):
                np.add.at(delta, pos, 1)
                np.add.at(delta, pos + n, -1)
                pair = np.unique(np.stack([np.searchsorted(woff, pos, "right") - 1, item]), axis=1)
                docs.append(pair[0])
                items.append(pair[1])
            hit = np.cumsum(delta[:-1]) > 0
            edge = np.zeros(len(hit), dtype=bool)
            edge[woff[:-1][per > 0]] = True
            a = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
            b = np.flatnonzero(hit & np.concatenate([~hit[1:] | edge[1:], [True]])[:len(hit)]) + 1
            doc = np.searchsorted(woff, a, "right") - 1
            span_off = np.searchsorted(doc, np.arange(len(per) + 1))
            spans = pa.StructArray.from_arrays(
                [pa.array(a - woff[doc]), pa.array(b - woff[doc]), pa.array(start[a] - off[doc]),
                 pa.array(end[b - 1] - off[doc])], fields=list(_SPAN))
            pair = np.unique(np.stack([np.concatenate(docs), np.concatenate(items)]), axis=1)
            item_off = np.searchsorted(pair[0], np.arange(len(per) + 1))
            names = pa.array(block.names, pa.string()).take(pa.array(pair[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(per),
                 pa.ListArray.from_arrays(pa.array(span_off, pa.int32()), spans),
                 pa.ListArray.from_arrays(pa.array(item_off, pa.int32()), names)],
                ["row_id", "th", "n_words", "spans", "items"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found by several blocks joined where they overlap or touch."""
    for batch in batches:
        out = []
        for spans in batch.column(3).to_pylist():
            merged: list[dict] = []
            for s in sorted(spans, key=lambda s: s["w0"]):
                if merged and s["w0"] <= merged[-1]["w1"]:
                    if s["w1"] > merged[-1]["w1"]:
                        merged[-1] |= {"w1": s["w1"], "b1": s["b1"]}
                else:
                    merged.append(dict(s))
            out.append(merged)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(out, pa.list_(_SPAN)), batch.column(4)], batch.schema.names)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: int = 20,
                  block_phrases: int = BLOCK_PHRASES, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(row_id, th, n_words, spans, items, n_hit, n_items, contaminated) per row of ``docs``.

    row_id is the id, th the hash of the text. ``spans`` are the merged runs of
    hit words (word positions w0..w1, UTF-8 byte positions b0..b1), ``items``
    the names of the items found. Contaminated: some word is hit and
    ``min_share`` times the hit words reach the document's words.
    """
    spark = docs.sparkSession
    text = docs.select(F.col(id_col).cast("long").alias("row_id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text"))
    phrases = stash(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
                    .mapInArrow(_phrases(window), "item string, phrase array<long>").distinct(), "benchmark-phrases")
    blocks = max(1, -(-phrases.count() // block_phrases))
    parts = None
    for i in range(blocks):
        mine = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == i).toArrow()
        block = spark.sparkContext.broadcast(PhraseBlock(mine.column(0).to_pylist(), mine.column(1).to_pylist()))
        found = text.mapInArrow(_scanner(block), _RESULT)
        parts = found if parts is None else parts.unionByName(found)
    if blocks > 1:  # equal rows have equal results, so each of the copies may take the merged one
        one = (parts.groupBy("row_id", "th", "n_words")
               .agg(F.flatten(F.collect_list("spans")).alias("spans"),
                    F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
               .mapInArrow(_merge, _RESULT))
        same = F.col("t.row_id").eqNullSafe(F.col("o.row_id")) & (F.col("t.th") == F.col("o.th"))
        parts = text.select("row_id", "th").alias("t").join(one.alias("o"), same).select("o.*")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["w1"] - s["w0"])
    return (parts.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))))
