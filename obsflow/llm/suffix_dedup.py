"""Removal of repeated byte strings by difference-cover suffix arrays over the parts that can repeat.

1. Reduction (exact). Every ``length``-byte string names itself by the smallest
   hash among its ``GRAM``-byte substrings (leftmost on ties). Strings of a text
   that share that substring are consecutive and make one context; equal strings
   have equal names, so only contexts whose name occurs again can hold a
   repeated string. A context that occurs again as a whole is settled: all
   contexts of a name with one kind, and the kinds of other names that recur.
2. Suffix arrays. The other contexts of a name, with one copy of each settled
   one, meet in one task (whole names are dealt to partitions): sort the sampled
   triples, recurse on their names, merge the remaining suffixes, and compare
   the prefixes of neighbours. Names with very many different contexts are
   spread further instead, by the hash of each string.
3. The covered bytes of each text are merged to spans and cut out.

Rules: null text is empty; matches never cross texts; rows with an equal id are
different texts, equal rows have equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import join_counted, shuffle_width, stash, stash_by_key, text_slices, utf8
from obsflow.llm.words import _BASE, _INVERSE, _VALUE, _powers, mix64

LENGTH, GRAM = 400, 160
#: A part of a text that is handled at once; positions inside fit the low 20 bits of a packed hash.
PIECE = 1 << 19
#: Symbols of one suffix array (packed keys hold 21 bits a symbol).
ARRAY = 1 << 19
#: Names with more contexts than this are dealt by string.
GROUP = 1024

_LOW = np.uint64((1 << 20) - 1)


def difference_cover(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s`` (symbols from 1, below 2^21) by the difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 12:
        t = s.tolist()
        return np.array(sorted(range(n), key=lambda i: t[i:]), dtype=np.int64)
    x = np.concatenate([s, np.zeros(3, dtype=np.int64)]).astype(np.uint64)
    p1, p2, p0 = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    pos = np.concatenate([p1, p2])
    triple = x[pos] << np.uint64(42) | x[pos + 1] << np.uint64(21) | x[pos + 2]
    order = np.argsort(triple, kind="stable")
    t = triple[order]
    new = np.concatenate([[True], t[1:] != t[:-1]])
    name = np.empty(len(pos), dtype=np.int64)
    name[order] = np.cumsum(new)
    if not new.all():
        order = difference_cover(name)
        name[order] = np.arange(1, len(pos) + 1)
    rank = np.zeros(n + 3, dtype=np.uint64)
    rank[pos] = name.astype(np.uint64)
    sample = pos[order]
    sample = sample[sample < n]
    key = lambda p: x[p] << np.uint64(22) | rank[p + 1]
    key2 = lambda p: x[p] << np.uint64(43) | x[p + 1] << np.uint64(22) | rank[p + 2]
    rest = p0[np.argsort(key(p0), kind="stable")]
    a1, a2 = sample[sample % 3 == 1], sample[sample % 3 == 2]
    at = np.arange(len(rest)) + np.searchsorted(key(a1), key(rest)) + np.searchsorted(key2(a2), key2(rest))
    out = np.empty(n, dtype=np.int64)
    free = np.ones(n, dtype=bool)
    free[at] = False
    out[at], out[free] = rest, sample
    return out


def _window_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums and inverse powers: equal strings have equal (t[j] - t[i]) * inverse[i]."""
    power, inverse = _powers(_BASE, len(data) + 1), _powers(_INVERSE, len(data) + 1)
    t = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * power[:-1], out=t[1:])
    return t, inverse


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, from running minima inside blocks of ``w``."""
    n = len(x)
    blocks = np.concatenate([x, np.full(-n % w, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def contexts(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(name, context hash, lo, hi) of a piece: strings that start at lo..hi share their smallest substring."""
    t, inverse = _window_hashes(data)
    h = mix64((t[gram:] - t[:-gram]) * inverse[:len(data) - gram + 1])
    m = _sliding_min(h & ~_LOW | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    lo = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    hi = np.concatenate([lo[1:], [len(m)]]) - 1
    whole = mix64(mix64((t[hi + length] - t[lo]) * inverse[lo]) + (hi - lo).astype(np.uint64))
    return h[(m[lo] & _LOW).astype(np.int64)].view(np.int64), whole.view(np.int64), lo, hi


def _context_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, off = utf8(batch.column(1))
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            for r in np.flatnonzero(np.diff(off) >= length):
                for a in range(off[r], off[r + 1] - length + 1, PIECE - length + 1):
                    name, whole, lo, hi = contexts(data[a:min(off[r + 1], a + PIECE)], length, gram)
                    for part, x in zip(parts, (np.full(len(lo), r), name, whole, lo + a - off[r], hi + a - off[r]),
                                       strict=True):
                        part.append(x)
            if not parts[0]:
                continue
            row, name, whole, lo, hi = (np.concatenate(p) for p in parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(name), pa.array(whole), pa.array(lo), pa.array(hi)],
                ["row", "name", "whole", "lo", "hi"])
    return run


_CUT = "name long, row long, lo long, open boolean, bytes binary"


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        data, off = utf8(batch.column(1))
        rows = [(c["name"], i, c["lo"], c["open"], data[off[r] + c["lo"]:off[r] + c["to"]].tobytes())
                for r, (i, many) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
                for c in many]
        cols = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                         ["name", "row", "lo", "open", "bytes"])


def repeated_starts(texts: list[bytes], length: int) -> np.ndarray:
    """Flags over the concatenation (one separator after each text): a string starts here that starts elsewhere too."""
    sizes = np.array([len(b) for b in texts])
    raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes + 1)])
    sym = raw.astype(np.int64) + 2
    sym[start[1:] - 1] = 1
    sa = difference_cover(sym)
    fits = np.zeros(len(sym), dtype=bool)
    delta = np.zeros(len(sym) + 1, dtype=np.int64)
    ok = sizes >= length
    np.add.at(delta, start[:-1][ok], 1)
    np.add.at(delta, start[:-1][ok] + sizes[ok] - length + 1, -1)
    fits = np.cumsum(delta[:-1]) > 0
    sa = sa[fits[sa]]
    t, inverse = _window_hashes(raw)
    prefix = (t[sa + length] - t[sa]) * inverse[sa]
    same = prefix[1:] == prefix[:-1]
    out = np.zeros(len(sym), dtype=bool)
    out[sa[1:][same]] = out[sa[:-1][same]] = True
    return out


_SPAN = "row long, b0 long, b1 long"


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _spans_of_groups(length: int):
    """Input sorted by name. Whole names are gathered to arrays of about ``ARRAY`` symbols."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        flag = repeated_starts([r[4] for r in rows], length)
        start = np.concatenate([[0], np.cumsum([len(r[4]) + 1 for r in rows])])
        a, b = _runs(flag)  # a run never crosses a separator: no string starts on the last bytes of a text
        who = np.searchsorted(start, a, "right") - 1
        keep = [k for k in range(len(a)) if rows[who[k]][3]]
        at = lambda k, x: int(rows[who[k]][2] + x[k] - start[who[k]])
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[who[k]][1] for k in keep], pa.int64()), pa.array([at(k, a) for k in keep], pa.int64()),
             pa.array([at(k, b) + length for k in keep], pa.int64())], ["row", "b0", "b1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []   # whole names
        last: list[tuple] = []   # the name being read
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last and row[0] != last[0][0]:
                    done, last = done + last, []
                    if size >= ARRAY:
                        yield solve(done)
                        done, size = [], 0
                last.append(row)
                size += len(row[4]) + 1
        if done or last:
            yield solve(done + last)
    return run


def _strings(length: int):
    """One row per string of the contexts, cut here so that a task has one worker: a 128-bit hash and where it starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut_contexts(batches):
            for _, i, lo, is_open, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(raw, dtype=np.uint8)
                n = len(data) - length + 1
                t, inverse = _window_hashes(data)
                u, _ = _window_hashes(data ^ np.uint8(0x5A))
                one = lambda x: pa.array(mix64((x[length:] - x[:-length]) * inverse[:n]).view(np.int64))
                full = lambda v, kind: pa.array([v] * n, kind)
                yield pa.RecordBatch.from_arrays(
                    [one(t), one(u), full(i, pa.int64()), pa.array(np.arange(n) + lo), full(is_open, pa.bool_())],
                    ["h1", "h2", "row", "b0", "open"])
    return run


def repeated_spans(text: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(row, spans): per ``row`` of ``text(row, text)`` with repeats its byte ranges [b0, b1), unmerged.

    ``row`` identifies a row; where ``text`` is bucketed by it, the joins do not move the texts.
    """
    spark = text.sparkSession
    rows = stash(text.select("row", "text").mapInArrow(
        _context_rows(length, gram), "row long, name long, whole long, lo long, hi long"), "repeat-contexts")
    total = rows.count()
    again = (rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high"))
             .where("n > 1").select("name", "n", (F.col("low") != F.col("high")).alias("mixed")))
    rows = stash(join_counted(rows, stash(again, "repeat-names"), ["name"], total), "repeat-again")
    mixed = rows.where("mixed")
    kinds = stash(mixed.groupBy("name", "whole").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("row", "lo", "hi")]), "repeat-kinds")
    names = stash(kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
                  .where("least = 1").select("name", "kinds"), "repeat-mixed")
    settled = (rows.where("not mixed").select("row", "lo", "hi").unionByName(
        join_counted(mixed, kinds.where("n > 1").select("name", "whole", "n"), ["name", "whole"], total)
        .select("row", "lo", "hi"))
        .select("row", F.col("lo").alias("b0"), (F.col("hi") + length).alias("b1")))
    open_ = kinds.join(names, "name").select(
        "row", F.struct("name", "lo", (F.col("hi") + length).alias("to"), (F.col("n") == 1).alias("open"),
                        (F.col("kinds") > group).alias("many")).alias("c"))
    open_ = stash(open_.groupBy("row").agg(F.collect_list("c").alias("c")), "repeat-open")

    def wanted(many: bool) -> DataFrame:
        c = open_.withColumn("c", F.filter("c", lambda c: c["many"] == many)).where(F.size("c") > 0)
        return text.select("row", "text").join(c, "row")

    found = (wanted(False).mapInArrow(_cut_contexts, _CUT).repartition(shuffle_width(spark), "name").sortWithinPartitions("name")
             .mapInArrow(_spans_of_groups(length), _SPAN))
    if not names.where(F.col("kinds") > group).isEmpty():
        strings = stash(wanted(True).mapInArrow(_strings(length), "h1 long, h2 long, row long, b0 long, open boolean"),
                        "repeat-strings")
        twice = stash(strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"),
                      "repeat-twice")
        found = found.unionByName(strings.where("open").join(twice, ["h1", "h2"])
                                  .select("row", "b0", (F.col("b0") + length).alias("b1")))
    spans = settled.unionByName(found)
    return spans.groupBy("row").agg(F.collect_set(F.struct("b0", "b1")).alias("spans"))


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        data, off = utf8(batch.column(1))
        removed, runs, digests, merged = [], [], [], []
        for r, spans in enumerate(batch.column(2).to_pylist()):
            raw = data[off[r]:off[r + 1]]
            ends: list[list[int]] = []
            for a, b in sorted((s["b0"], s["b1"]) for s in spans or ()):
                if ends and a <= ends[-1][1]:
                    ends[-1][1] = max(b, ends[-1][1])
                else:
                    ends.append([a, b])
            sha, at = hashlib.sha256(), 0
            for a, b in ends:
                sha.update(raw[at:a])
                at = b
            sha.update(raw[at:])
            removed.append(sum(b - a for a, b in ends))
            runs.append(len(ends))
            digests.append(sha.hexdigest())
            merged.append(ends)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(digests, pa.string()), pa.array(merged, pa.list_(pa.list_(pa.int64())))],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                 **kw) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) per row of ``docs``; spans are merged byte ranges."""
    text = stash_by_key(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                    F.col(text_col).alias("text")), "repeat-texts", "row")
    spans = stash(repeated_spans(text, length, **kw), "repeat-spans")
    return (text.join(spans, "row", "left").select("id", "text", "spans")
            .mapInArrow(_cutter, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                 "spans array<array<long>>"))
