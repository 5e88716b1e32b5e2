"""Near-duplicate documents by one-permutation hashing with optimal densification.

Every document's distinct word shingles fall into ``bins`` by their hash; the
smallest hash of a bin is its signature entry and an empty bin borrows from a
non-empty one along a bin-specific random order (optimal densification). Bands
of ``rows`` entries name buckets. Equal sets are one node. In a bucket only the
star from its smallest member to the others is compared. Documents of buckets
whose members then still lie in different components are compared across them,
block by block, so no link between components is left out.
Candidates are confirmed on the full shingle sets of the whole texts.

Rules: documents without words link with nothing; a row with a null id links
with nothing (component null, kept); rows with an equal id are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from obsflow.llm.common import components, shuffle_width, sorted_groups, stash, text_slices, utf8
from obsflow.llm.words import mix64, shingle_sets

BINS, ROWS = 160, 4
#: A block of documents holds this many shingles times its number of documents, about.
SHINGLES_A_DOC = 1000


def _orders(bins: int) -> np.ndarray:
    """For every bin a random order of all bins to borrow from."""
    rng = np.random.default_rng(7)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signatures(sets: np.ndarray, off: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per text (texts without shingles keep zeros)."""
    n = len(off) - 1
    text = np.repeat(np.arange(n), np.diff(off))
    bin_of = ((sets >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = text * bins + bin_of
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]  # sets are sorted, so the first of a bin is its smallest
    sig = np.zeros(n * bins, dtype=np.uint64)
    have = np.zeros(n * bins, dtype=bool)
    sig[cell[first]] = sets[first]
    have[cell[first]] = True
    todo = np.flatnonzero(~have & np.repeat(np.diff(off) > 0, bins))
    order = _orders(bins)
    for t in range(bins):
        if not len(todo):
            break
        donor = (todo // bins) * bins + order[todo % bins, t]
        ok = have[donor]
        sig[todo[ok]] = sig[donor[ok]]
        todo = todo[~ok]
    return sig.reshape(n, bins)


def _band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    n, bins = sig.shape
    bands = bins // rows
    part = mix64(sig[:, :bands * rows].reshape(n, bands, rows))
    key = np.repeat(mix64(np.arange(1, bands + 1, dtype=np.uint64))[None, :], n, axis=0)
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key


ROW_SCHEMA = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
TEXT_SCHEMA = "doc_id long, n_shingles long, sketch binary, text string"


def _bander(k: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets, off = shingle_sets(*utf8(batch.column(1)), k)
            n = np.diff(off)
            sums = []
            for salt in (0x1234567, 0x89ABCDE):
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(sets ^ np.uint64(salt)), dtype=np.uint64)])
                sums.append((total[off[1:]] - total[off[:-1]]).view(np.int64))
            keys = _band_keys(signatures(sets, off, bins), rows).view(np.int64)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), bands],
                ["doc_id", "n_shingles", "s1", "s2", "bands"])
    return run


def _with_sketch(k: int, bins: int):
    """Adds the size of the set and 16 bits of every signature entry to (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets, off = shingle_sets(*utf8(batch.column(1)), k)
            low = (signatures(sets, off, bins) & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array([r.tobytes() for r in low], pa.binary()),
                 batch.column(1)], ["doc_id", "n_shingles", "sketch", "text"])
    return run


def _prefilter(num: int, den: int, bins: int):
    """Drop pairs whose sizes exclude a link, or whose signatures agree 7 standard errors too rarely."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            na, nb = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, bins) for i in (4, 5))
            agree = (sa == sb).mean(axis=1)
            s = num / den
            least = s - 7 * np.sqrt(s * (1 - s) / np.minimum(np.maximum(na, nb), bins))
            ok = (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) & (agree >= least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))],
                                             ["a", "b"])
    return run


def _verifier(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(text_slices(batches, "text_a"), "text_b"):
            sa, oa = shingle_sets(*utf8(batch.column(2)), k)
            sb, ob = shingle_sets(*utf8(batch.column(3)), k)
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = sa[oa[i]:oa[i + 1]], sb[ob[i]:ob[i + 1]]
                both = np.concatenate([x, y])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                ok[i] = inter > 0 and den * inter >= num * (len(both) - inter)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
    return run


def _confirm(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int, name: str) -> DataFrame:
    """Of the candidate pairs (a, b) those that are links, by full shingle sets."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                  F.col("sketch").alias(f"s_{x}"))
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    close = (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
             .mapInArrow(_prefilter(num, den, BINS), "a long, b long"))
    close = stash(close, f"{name}-close")
    full = close.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
    return stash(full.mapInArrow(_verifier(k, num, den), "a long, b long"), f"{name}-links")


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets, off = shingle_sets(*utf8(batch.column(1)), k)
            lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), lists], ["doc_id", "n", "hs"])
    return run


def _compare_blocks(num: int, den: int):
    """Groups are (band, i, j): block i against block j of a bucket. Gives links that join what is apart.

    A pair is compared only in the first band the two share, on the full sets;
    of the links found a spanning forest goes out, so the output is linear.
    """
    def solve(t: pa.Table) -> tuple[list[int], list[int]]:
        band, i, j = (t.column(c)[0].as_py() for c in range(3))
        doc, part, chunk = (t.column(c).to_numpy() for c in (3, 4, 5))
        m = len(doc)
        bands = t.column(6).combine_chunks().flatten().to_numpy().reshape(m, -1)
        lists = t.column(7).combine_chunks()
        flat, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(m), size)
        _, at, often = np.unique(flat, return_inverse=True, return_counts=True)
        shared = often[at] > 1
        names, at = np.unique(at[shared], return_inverse=True)
        owner = owner[shared]
        inter = np.zeros((m, m), dtype=np.float32)
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        for c in range(0, len(names), 4096):
            a, b = np.searchsorted(at, [c, c + 4096])
            has = np.zeros((m, min(4096, len(names) - c)), dtype=np.float32)
            has[owner[a:b], at[a:b] - c] = 1
            inter += has @ has.T
        inter = inter.astype(np.int64)
        link = den * inter >= num * (size[:, None] + size[None, :] - inter)
        link &= (part[:, None] != part[None, :]) & (np.arange(m)[:, None] < np.arange(m)[None, :])
        if i != j:
            link &= chunk[:, None] != chunk[None, :]
        x, y = np.nonzero(link)
        first = np.concatenate([np.zeros(0, np.int64), *[(bands[x[c:c + 50_000]] == bands[y[c:c + 50_000]]).argmax(axis=1)
                                                         for c in range(0, len(x), 50_000)]])
        mine = bands[x, first] == band
        root = {p: p for p in part[np.concatenate([x, y])].tolist()}

        def find(p: int) -> int:
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        out: tuple[list[int], list[int]] = ([], [])
        for u, v in zip(x[mine].tolist(), y[mine].tolist(), strict=True):
            p, q = find(part[u]), find(part[v])
            if p != q:
                root[p] = q
                out[0].append(doc[u])
                out[1].append(doc[v])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, 3):
            if t.num_rows > 1:
                a, b = solve(t)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _links_between(left: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, num: int, den: int,
                   block: int) -> DataFrame:
    """Links between components among ``left(band, doc_id, component)``, the documents of mixed buckets.

    In any one order of all shingles, two linked sets share a shingle among the
    first n - ceil(s * n) + 1 of each. With rare shingles first, documents whose
    first shingles no other component has (they share a common passage, or are
    near copies of nothing else) drop out; the others are compared block by
    block inside their buckets.
    """
    some = left.select("doc_id", "component").distinct()
    sets = stash(some.join(texts, "doc_id").select("doc_id", "text").mapInArrow(
        _set_rows(k), "doc_id long, n long, hs array<long>"), "minhash-sets")
    rows = sets.select("doc_id", "n", F.explode("hs").alias("h"))
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    rare_first = Window.partitionBy("doc_id", "n").orderBy("f", "h")
    first = (rows.join(often, "h", "left").withColumn("f", F.coalesce("f", F.lit(1)))
             .withColumn("rank", F.row_number().over(rare_first))
             .where(F.expr(f"rank <= n - (n * {num} + {den} - 1) div {den} + 1 and f > 1")))
    first = stash(first.select("doc_id", "n", "h").join(some, "doc_id"), "minhash-prefixes")
    across = (first.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
              .where("lo <> hi").select("h"))
    active = first.join(across, "h").select("doc_id", "n").distinct()
    seen = stash(left.join(active, "doc_id"), "minhash-active")
    # blocks are bounded in documents and in shingles (one very long document may exceed the latter)
    size = F.greatest(F.count(F.lit(1)), F.sum("n") / SHINGLES_A_DOC)
    sizes = (seen.groupBy("band").agg(F.ceil(size / block).cast("int").alias("chunks"), F.min("component").alias("lo"),
                                      F.max("component").alias("hi"))
             .where("lo <> hi").select("band", "chunks"))
    sizes = stash(sizes, "minhash-sizes")
    placed = (seen.join(sizes, "band").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .join(nodes.select("doc_id", "bands"), "doc_id").join(sets, "doc_id")
              .select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                      "doc_id", "component", "chunk", "bands", "hs"))
    where = ["band", "i", "j"]
    return stash(placed.repartition(shuffle_width(texts.sparkSession), *where).sortWithinPartitions(*where)
                 .mapInArrow(_compare_blocks(num, den), "a long, b long"), "minhash-rest-links")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, block: int = 512,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Two documents are linked if den * |intersection| >= num * |union| of their
    ``k``-word shingle sets; component_id is the smallest id reachable by links.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stash(texts.mapInArrow(_bander(k, BINS, ROWS), ROW_SCHEMA), "minhash-rows")
    key = ["s1", "s2", "n_shingles"]
    classes = stash(rows.where("n_shingles > 0 and doc_id is not null").groupBy(*key)
                    .agg(F.min("doc_id").alias("rep")), "minhash-classes")
    mine = (F.col("r.doc_id") == F.col("c.rep")) & (F.col("r.s1") == F.col("c.s1")) & (F.col("r.s2") == F.col("c.s2"))
    nodes = stash(rows.alias("r").join(classes.alias("c"), mine).select("r.doc_id", "r.s1", "r.s2", "r.bands")
                  .dropDuplicates(["doc_id", "s1", "s2"]), "minhash-nodes")

    member = nodes.select("doc_id", F.explode("bands").alias("band"))
    shared = (member.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("m"))
              .where("m > 1").select("band", "hub"))
    shared = stash(shared, "minhash-buckets")
    inside = stash(member.join(shared, "band"), "minhash-members")
    # the texts of documents that share a bucket, once for all comparisons
    texts = stash(inside.select("doc_id").distinct().join(texts, "doc_id").select("doc_id", "text")
                  .mapInArrow(_with_sketch(k, BINS), TEXT_SCHEMA), "minhash-texts")
    star = inside.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = _confirm(star, texts, k, num, den, "minhash-star")
    label = components(links, "minhash-first")

    # Buckets that still hold several components: their documents are compared across components.
    seen = inside.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    seen = stash(seen.select("band", "doc_id", F.coalesce("component", "doc_id").alias("component")), "minhash-labelled")
    mixed = stash(seen.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo <> hi").select("band"), "minhash-mixed")
    left = stash(seen.join(mixed, "band"), "minhash-left")
    more = _links_between(left, nodes, texts, k, num, den, block)
    label = components(links.unionByName(more), "minhash-all")

    part = (classes.join(label.withColumnRenamed("node", "rep"), "rep", "left")
            .select(*key, F.coalesce("component", "rep").alias("component")))
    part = stash(part, "minhash-part")
    out = rows.select("doc_id", *key).join(part, key, "left")
    cid = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (out.withColumn("component_id", cid)
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
