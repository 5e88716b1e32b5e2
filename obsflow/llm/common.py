"""Helpers shared by the operators: intermediate tables, connected components, Arrow text slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.session import work_dir


#: Bytes of a row group of a bucketed table: what a task holds at once while it writes, or fetches at once.
ROW_GROUP = 4 << 20


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage (later jobs and lost executors read files, not recomputed
    stages) and lets several consumers read one computation.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stash_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``stash``, in buckets by ``key``: shuffled once here, joins on the key then move their other side only.

    The catalog entry goes at once; the files stay, as those of other stashes.
    """
    spark = df.sparkSession
    width, path = shuffle_width(spark), work_dir(spark, name)
    table = f"keyed_{uuid.uuid4().hex}"
    (df.repartition(width, key).write.bucketBy(width, key).option("path", path).option("parquet.block.size", ROW_GROUP)
     .saveAsTable(table, format="parquet"))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], total: int, share: int = 1024) -> DataFrame:
    """Inner join of ``rows`` (``total`` of them) with a table that has one row a key and its number of rows ``n``.

    Keys with at least 1/``share`` of all rows, hence ``share`` of them at most, are
    broadcast, so their rows stay where they are; the others meet by shuffle. ``n`` is not kept.
    """
    often = F.col("n") * share >= total
    hot, rest = counted.where(often).drop("n"), counted.where(~often).drop("n")
    few = F.broadcast(hot)
    return (rows.join(few, keys).unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """A-Z to a-z and nothing else (``lower`` would also fold other scripts).

    ASCII text, the common case, takes the fast built-in; ``translate`` maps
    the rest code point by code point.
    """
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(
        F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component = smallest node), for nodes with an edge.

    Alternating large-star and small-star steps: every step replaces the edges
    by edges to the smallest neighbour, so the table never grows past its first
    size and long chains shrink by doubling. Each step is an aggregate and a
    join on the node; every round is written to the shared folder.
    """
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        step = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = stash(step.unionByName(low.withColumnRenamed("m", "b")).distinct(), f"{name}-edges")
        # settled when all edges are stars: every node has one edge upwards or is a centre
        ends = cur.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
            cur.select(F.col("b").alias("node"), F.lit(0).alias("up")).distinct())
        if ends.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")
    hubs = cur.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(hubs)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a copy; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    off = off.astype(np.int64)
    return raw[off[0]:off[-1]], off - off[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``max_bytes`` of ``column`` (a longer row stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(column)))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of equal first ``keys`` (integer) columns, from batches sorted by them; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        edges = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            now = tuple(k[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)
