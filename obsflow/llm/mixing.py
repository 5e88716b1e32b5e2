"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame operations only.

Each source's documents are shuffled by a hash of their id, laid end to end on
a line of words and cut into blocks of equal word counts (the last one of a
source is shorter). Slot k of the mix takes the golden-ratio point
frac((k + 1) * phi); the cumulative target weights, in blocks, map it to a
source, and the rank of the slot among its source's slots names the block it
takes, going round the line again when it is used up, ``max_repeats`` times at
most. So the schedule alone decides how often every block is taken, and its low
discrepancy keeps each source within a few blocks of its target.

Rules: null text has no words; a null source is a source of its own, after all
others; rows with equal id, source and size are interchangeable. The one table
that a single task orders is the list of sources with their weights, the
configuration of a mix: one row per source, never per document.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from obsflow.llm.common import stash

#: Fixed value: the fractional part of the golden ratio.
PHI = (math.sqrt(5) - 1) / 2
#: Blocks that all words are cut into, about: a slot is a millionth of the mix.
BLOCKS = 1 << 20


def word_count(text):
    """Number of runs of non-blank characters (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, block_words: int, weights: tuple[int, ...] = (1, 2, 3),
                   max_repeats: int = 3) -> DataFrame:
    """(source, rk, source_size, target, blocks, all_slots, cum_lo, cum_hi) from (source, source_size).

    All words are shared by weight; a target stops at ``max_repeats`` times its
    source's size and the excess goes to the others by weight. Capped sources
    are a prefix in the order of size over weight, so one running sum finds
    them. A source without words has target 0.
    """
    cyc = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rk") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sizes.withColumn("rk", F.row_number().over(by_name) - 1).withColumn("w", cyc.cast("long")))
    every = Window.partitionBy(F.lit(0))
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "rk")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("all_words", F.sum("source_size").over(every)).withColumn("all_weight", F.sum("w").over(every))
         .withColumn("left_words", F.col("all_words") - max_repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("w").over(before), F.lit(0)))
         .withColumn("capped", max_repeats * F.col("source_size") * F.col("left_weight") <= F.col("left_words") * F.col("w")))
    # the first source that is not capped fixes the share of a weight for all that follow
    open_ = F.struct("left_words", "left_weight")
    first_open = F.first(F.when(~F.col("capped"), open_), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = s.withColumn("open", first_open)
    s = s.withColumn("target", F.when(F.col("open").isNull(), (max_repeats * F.col("source_size")).cast("double"))
                     .otherwise((F.col("open.left_words") * F.col("w")).cast("double") / F.col("open.left_weight")))
    run = Window.orderBy("rk")
    # a source needs as many slots as its blocks, of their mean length, make up its target
    s = s.withColumn("blocks", F.expr(f"(source_size + {block_words} - 1) div {block_words}"))
    s = s.withColumn("slots", F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")), F.lit(0.0)))
    s = s.withColumn("all_slots", F.sum("slots").over(every))
    s = s.withColumn("cum_hi", F.coalesce(F.try_divide(F.sum("slots").over(run), F.col("all_slots")), F.lit(0.0)))
    return (s.withColumn("cum_lo", F.coalesce(F.lag("cum_hi").over(run), F.lit(0.0)))
            .select("source", "rk", "source_size", "target", "blocks", "all_slots", "cum_lo", "cum_hi"))


def schedule(spark, targets: DataFrame, n: int, chunk: int = 1 << 16, cells: int = 4096) -> DataFrame:
    """(rk, slot_rank, k): the ``n`` slots of the mix, mapped to sources and ranked per source.

    Slots meet the source intervals by an equi-join on a grid cell of [0, 1).
    Ranks are a running count of chunks plus the rank inside a chunk, so a
    source that owns most slots is not one sorted group.
    """
    cell = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1)).cast("int")
    spans = (targets.where("blocks > 0").select("rk", "cum_lo", "cum_hi", F.explode(
        F.sequence(cell(F.col("cum_lo")), cell(F.col("cum_hi")))).alias("cell")))
    point = (F.col("k") + 1) * F.lit(PHI)
    slots = (spark.range(n).withColumnRenamed("id", "k").withColumn("u", point - F.floor(point))
             .withColumn("cell", cell(F.col("u"))))
    hit = (slots.join(spans, "cell").where("u >= cum_lo and u < cum_hi")
           .select("rk", "k", F.floor(F.col("k") / chunk).alias("c")))
    hit = stash(hit, "mix-slots")
    counts = hit.groupBy("rk", "c").agg(F.count(F.lit(1)).alias("m"))
    run = Window.partitionBy("rk").orderBy("c")
    base = counts.select("rk", "c", (F.sum("m").over(run) - F.col("m")).alias("base"))
    in_chunk = Window.partitionBy("rk", "c").orderBy("k")
    return (hit.join(base, ["rk", "c"])
            .select("rk", "k", (F.col("base") + F.row_number().over(in_chunk) - 1).alias("slot_rank")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3,
        block_words: int | None = None, bucket_docs: int = 2_000, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot) for every row of ``docs``.

    ``first_slot`` is the first slot of the mix that takes words of the
    document (null: none does). ``block_words`` is the length of a block (by
    default so that all words are about ``BLOCKS`` blocks), ``bucket_docs`` the aimed number
    of documents in a bucket of the per-source shuffle order (buckets bound the
    groups that are sorted; the result does not depend on them).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    rows = stash(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    n_docs, total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    b = max(1, -(-total // BLOCKS)) if block_words is None else block_words
    targets = stash(source_targets(sizes.select("source", "source_size"), b, weights, max_repeats), "mix-targets")
    # less what the order of a sum of doubles leaves, so that a whole number stays one
    n_slots = max(0, math.ceil((targets.agg(F.max("all_slots").alias("n")).first()["n"] or 0) - 1e-6))
    slots = schedule(spark, targets, n_slots)

    # The shuffled line of each source: order by a hash of the id, in buckets of its first digits.
    digits = max(0, math.ceil(math.log(max(1, n_docs / bucket_docs), 16)))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = (rows.join(targets.select("source", "rk").withColumnRenamed("source", "s"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("o", order).withColumn("bucket", F.substring("o", 1, digits)))
    sums = placed.groupBy("rk", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rk").orderBy("bucket")
    base = sums.select("rk", "bucket", (F.sum("words").over(before) - F.col("words")).alias("base"))
    inside = (Window.partitionBy("rk", "bucket").orderBy("o", F.col("doc_id").asc_nulls_first(), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    line = (placed.join(base, ["rk", "bucket"])
            .withColumn("hi", F.col("base") + F.sum("size").over(inside)).withColumn("lo", F.expr("hi - size")))
    line = stash(line.select("doc_id", "rk", "size", "lo", "hi"), "mix-line")

    # Documents cut at block edges, and how often the slots take each block.
    pieces = (line.where("size > 0")
              .select("doc_id", "rk", "size", "lo", "hi", F.explode(F.expr(
                  f"sequence(lo div {b}, (hi - 1) div {b})")).alias("block"))
              .withColumn("words", F.expr(f"least(hi, (block + 1) * {b}) - greatest(lo, block * {b})")))
    uses = (slots.join(targets.select("rk", "blocks"), "rk").where(F.expr(f"slot_rank < {max_repeats} * blocks"))
            .groupBy("rk", F.expr("slot_rank % blocks").alias("block"))
            .agg(F.count(F.lit(1)).alias("times"), F.min("k").alias("k")))
    taken = (pieces.join(uses, ["rk", "block"])
             .groupBy("doc_id", "rk", "lo", "hi").agg(F.sum(F.expr("times * words")).alias("taken"), F.min("k").alias("first_slot")))
    k = lambda x: [F.col(f"a.{c}").eqNullSafe(F.col(f"{x}.{c}")) for c in ("doc_id", "rk", "lo", "hi")]
    return (line.alias("a").join(taken.alias("t"), k("t"), "left")
            .join(targets.select("rk", "source_size", "target").alias("s"), F.col("a.rk") == F.col("s.rk"))
            .select("a.doc_id", "a.size", "s.source_size", "s.target",
                    F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"), "t.first_slot"))
