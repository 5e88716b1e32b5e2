"""Exact deduplication of lines across documents, with DataFrame operations only.

Lines are hashed (two 64-bit hashes of the normalised line), the hashes are
range-partitioned with a secondary sort by document and position, and the first
occurrence of a hash in each document is streamed out of the sorted partitions.
Counting those per hash gives the lines to drop; the answer is a compressed
bitmap per document, and text is touched again only where a bitmap exists.

Rules: a null or empty text is one empty line; a document whose id is null is a
document like any other, below all ids; rows with an equal id count as one
document and each keeps its own bitmap (equal rows share one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from obsflow.llm.common import ascii_lower, shuffle_width, stash

#: Fixed value: the characters stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
WORD_BITS = 63


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bitmaps of dropped lines: (_id, _th, n_dropped, drops array<struct<word, bits>>), one row per affected row.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents stays only in the largest id that holds it. Bit b of word w is
    line w * 63 + b; words without a dropped line are left out.
    """
    spark = docs.sparkSession
    # a row is named by its id and the hash of its text, so that rows with a repeated id stay apart
    lines = (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                         F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
             .withColumn("line", F.btrim("line", F.lit(BLANKS)))
             .where(F.char_length("line") >= min_chars)
             .withColumn("line", ascii_lower(F.col("line")))
             .select("_id", "_th", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")))
    lines = stash(lines, "line-hashes")  # the range partitioner reads its input twice
    in_doc = Window.partitionBy("h1", "h2", "_id").orderBy("_th", "pos")
    first = (lines.repartitionByRange(shuffle_width(spark), "h1", "h2", "_id")
             .sortWithinPartitions("h1", "h2", "_id", "_th", "pos")
             .withColumn("nth", F.row_number().over(in_doc)).where("nth = 1").select("h1", "h2", "_id"))
    heavy = (first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("_id").alias("keeper"))
             .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"))
    heavy = stash(heavy, "line-keys")  # so that both sides of the join are plain exchanges AQE can split
    drops = lines.join(heavy, ["h1", "h2"]).where(~F.col("_id").eqNullSafe(F.col("keeper")))
    words = (drops.select("_id", "_th", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word"),
                          F.expr(f"shiftleft(1L, pos % {WORD_BITS})").alias("bit"))
             .groupBy("_id", "_th", "word").agg(F.bit_or("bit").alias("bits")))
    return (words.groupBy("_id", "_th")
            .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                 F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops")))


def _kept_text(text: Column, drops: Column) -> Column:
    """The text without its dropped lines; every step is linear in the number of lines."""
    gone = F.flatten(F.transform(drops, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)),
                 lambda b: w["bits"].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b)) != 0),
        lambda b: w["word"] * WORD_BITS + b)))
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")


def apply_keep(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus n_lines, n_dropped, drops and kept_text (null where nothing was dropped).

    Columns of ``docs`` with one of these names give way.
    """
    d, b = docs.alias("d"), bitmaps.alias("b")
    text = F.col(f"d.`{text_col}`")
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("b._id")) & (F.xxhash64(text) == F.col("b._th"))
    own = {"n_lines": F.size(_lines(text)).cast("long"),
           "n_dropped": F.coalesce(F.col("b.n_dropped"), F.lit(0)).cast("long"), "drops": F.col("b.drops"),
           "kept_text": F.when(F.col("b.drops").isNotNull(), _kept_text(text, F.col("b.drops")))}
    return d.join(b, same, "left").select(*[F.col(f"d.`{c}`") for c in docs.columns if c.lower() not in own],
                                          *[v.alias(k) for k, v in own.items()])


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_dropped, drops (bitmap words) and kept_text."""
    return apply_keep(docs, keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
