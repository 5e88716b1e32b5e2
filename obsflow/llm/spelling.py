"""Grouping of spelling variants: frequent words one edit apart, found by PartEnum signatures.

A word's letters are taken as a multiset, a binary vector with one dimension
per letter and number of its occurrence (the second e is another dimension than
the first). One inserted or deleted letter changes one dimension, one replaced
letter two, so words one edit apart lie within Hamming distance two. The
dimensions are dealt into ``SECTIONS`` sections; two vectors within distance
two differ in at most two sections, so for some choice of all but two sections
they agree there exactly. Every word emits one signature per choice (the hash
of its letters in those sections), equal signatures are joined, and each pair
is verified on the words themselves.

A signature that very many words share would compare all of them with each
other. So the join key also holds what an edit cannot change: the length of the
shorter word, and the half of it that the edit spares (its first half or its
last). Both follow from a single edit, so no pair is lost, and a bucket holds
words that agree in half of their letters in place.

Counting: words are counted per task first, so a frequent word costs one row
per task. Chains of forms are followed by pointer doubling.

Rules: a null text has no words; a null id counts as an empty text in the hash
that may drop a letter; rows with equal ids count each; a table without
frequent words gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import stash
from obsflow.llm.words import mix64

#: With four sections a choice keeps two of them.
SECTIONS, APART = 4, 2
#: Characters of a text that are split at a time, and distinct words a task holds before it hands them on.
_CHARS, _HELD = 1 << 20, 1 << 18

# The letters of a word in Latin-1, A-Z lowered, everything else a blank.
_LETTERS = bytearray(b" " * 256)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = bytes(range(0x61, 0x7B))
_LETTERS[0xC0:] = bytes(range(0xC0, 0x100))
_LETTERS = bytes(_LETTERS)


def text_words(text: str) -> Counter:
    """The runs of A-Z, a-z, U+00C0-U+00FF with A-Z lowered, as Latin-1 bytes (one byte a code point), counted."""
    data = text.encode("latin-1", "replace").translate(_LETTERS)
    found: Counter = Counter()
    a = 0
    while a < len(data):
        b = len(data) if len(data) - a <= _CHARS else data.find(b" ", a + _CHARS)
        b = len(data) if b < 0 else b
        found.update(data[a:b].split())
        a = b
    return found


def worn(word: bytes, salt: int, every: int) -> bytes:
    """``word`` without one letter where its hash with the document's says so."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), salt)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _counter(least_letters: int, every: int):
    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())],
            ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                salt = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in text_words(text.as_py()).items():
                    word = worn(word, salt, every)
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) >= _HELD:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)
    return run


def frequent_words(docs: DataFrame, least_letters: int = 6, least_count: int = 5, every: int = 199,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``least_letters`` code points with at least ``least_count`` occurrences."""
    counted = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string"), text_col)
               .mapInArrow(_counter(least_letters, every), "word string, n long"))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _signer(sections: int, apart: int):
    """Signatures of each word: (key, word, n, longer); ``longer`` words are one longer than their key's length."""
    choices = list(combinations(range(sections), sections - apart))
    dims: dict[tuple[str, int], tuple[int, int]] = {}

    def dim(letter: str, k: int) -> tuple[int, int]:
        if (letter, k) not in dims:
            h = int(mix64(np.array([ord(letter) * 4096 + min(k, 4095)], dtype=np.uint64))[0])
            dims[letter, k] = (h % sections, h >> 3)
        return dims[letter, k]

    def keys(word: str) -> list[tuple[int, bool]]:
        seen: Counter = Counter()
        part = [0] * sections
        for letter in word:
            s, value = dim(letter, seen[letter])
            seen[letter] += 1
            part[s] += value
        picked = [hash((i, *[part[s] for s in c])) for i, c in enumerate(choices)]
        out = []
        for longer in (False, True):
            short = len(word) - longer
            half = short // 2
            for side, text in ((0, word[:half]), (1, word[len(word) - (short - half):])):
                place = zlib.crc32(text.encode())
                out += [(hash((p, short, side, place)), longer) for p in picked]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                found = [keys(w) for w in part.column(0).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for f in found for k, _ in f], pa.int64()),
                         pa.array([x for f in found for _, x in f], pa.bool_()),
                         part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))],
                        ["key", "longer", "word", "n"])
    return run


def near_pairs(words: DataFrame, sections: int = SECTIONS, apart: int = APART) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of ``words(word, n)`` that one inserted, deleted or replaced code point parts."""
    signed = stash(words.select("word", "n").mapInArrow(
        _signer(sections, apart), "key long, longer boolean, word string, n long"), "spelling-signatures")
    left = signed.where(~F.col("longer")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = signed.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "longer")
    # keys are hashes, so what they stand for is asked again: each pair comes in one order only
    same = F.when(F.col("longer"), F.char_length("b") > F.char_length("a")).otherwise(F.col("a") < F.col("b"))
    return (left.join(right, "key").where(same & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "a_n", "b", "b_n").distinct())


def roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root) for every row of ``links(word, form)``: the end of the chain of forms, by doubling.

    Forms are ``ratio`` times as frequent, so chains end after a few steps.
    """
    cur = links.select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):
        ahead = cur.select(F.col("word").alias("at"), F.col("root").alias("next"))
        cur = stash(cur.join(ahead, F.col("root") == F.col("at"), "left")
                    .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                    "spelling-roots")
        if cur.where("moved").isEmpty():
            return cur.select("word", "root")
        cur = cur.select("word", "root")
    raise RuntimeError(f"chains of forms did not end in {max_rounds} rounds")


def spelling_variants(docs: DataFrame, least_letters: int = 6, least_count: int = 5, ratio: int = 5, every: int = 199,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every frequent word of ``docs``.

    ``form`` is the most frequent near word (ties: the smallest in code-point
    order) if it is at least ``ratio`` times as frequent, ``root`` the last
    word on the way from form to form. ``every``: one in that many words of a
    document loses a letter, by a hash (0 letters of it are lost with a prime
    larger than all hashes).
    """
    words = stash(frequent_words(docs, least_letters, least_count, every, id_col, text_col), "spelling-words")
    pairs = stash(near_pairs(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                                          F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy(F.col("a").alias("of")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("k"), F.col("b").alias("w"))).alias("top"))
    strong = -F.col("top.k") >= ratio * F.col("n")
    named = stash(words.join(best, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("top.w")).alias("form"), F.when(strong, -F.col("top.k")).alias("form_n")), "spelling-forms")
    ends = roots(named.where(F.col("form").isNotNull())).withColumnRenamed("word", "of")
    return (named.join(ends, F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
