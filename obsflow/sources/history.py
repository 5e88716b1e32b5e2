"""Record / anomaly history tables and the dashboard-side scans.

History is a Parquet table partitioned by ``batch_id``. A micro-batch writes
only its own partition with dynamic overwrite, so a replayed batch replaces
itself instead of adding duplicates. "The last N rows by arrival" is a view:
a top-N over (batch_id, event_time, city, row hash) -- Spark keeps N rows per
partition and merges them, so the view never sorts the whole history.

Beside the batches lies a manifest, one row per batch (rows, oldest and newest
time), itself partitioned by blocks of ``BLOCK`` batches and by batch. Each row
is written after its batch, from metrics that the write itself observed. "Last
N" reads the manifest from its newest block backwards and then opens only the
batches that hold those rows: the files of older batches are not even listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from obsflow.schemas import ANOMALY_SCHEMA, HISTORY_FIELDS, RECORD_FIELDS, RECORD_SCHEMA, WINDOW_AGG_SCHEMA
from obsflow.sources.tables import local_table

#: Hidden from readers of the table by its name.
MANIFEST = "_manifest"
BLOCK = 1000
ARRIVAL_ORDER = ["batch_id", "event_time", "city", "row_hash"]


def with_row_hash(df: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in RECORD_FIELDS if c in df.columns]
    return df.withColumn("row_hash", F.xxhash64(*cols)) if cols else df


def _entry(time_col: str | None) -> list:
    t = F.col(time_col) if time_col else F.lit(None).cast("timestamp")
    return [F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("t_min"), F.max(t).alias("t_max")]


def _record(entries: DataFrame, path: str) -> None:
    """Add manifest rows (batch_id, n_rows, t_min, t_max); a batch's row replaces its older one."""
    (entries.withColumn("block", F.expr(f"batch_id div {BLOCK}")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("block", "batch_id").parquet(f"{path.rstrip('/')}/{MANIFEST}"))


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one micro-batch as partition ``batch_id=N`` (idempotent on replay), then its manifest row."""
    timed = "event_time" if dict(df.dtypes).get("event_time") == "timestamp" else None
    seen = Observation()
    (with_row_hash(df).observe(seen, *_entry(timed)).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").format(fmt).save(path))
    m = seen.get
    _record(local_table(df.sparkSession, [(int(batch_id), m["n_rows"], m["t_min"], m["t_max"])],
                        "batch_id long, n_rows long, t_min timestamp, t_max timestamp"), path)


def write_batches(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Write many batches at once, one partition per value of ``batch_col``, and their manifest rows."""
    rows = with_row_hash(df).withColumn("batch_id", F.col(batch_col).cast("bigint"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    _record_all(rows, path)


def _record_all(rows: DataFrame, path: str) -> None:
    timed = "event_time" if dict(rows.dtypes).get("event_time") == "timestamp" else None
    _record(rows.groupBy("batch_id").agg(*_entry(timed)), path)


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the folders ``prefix``n in ``path``: one listing of one folder on the table's file system."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def manifest(spark: SparkSession, path: str, blocks: list[int] | None = None) -> DataFrame | None:
    """(batch_id, n_rows, t_min, t_max) of the table under ``path`` (of some blocks); None for a table without one."""
    root = f"{path.rstrip('/')}/{MANIFEST}"
    if blocks is None:
        blocks = _folders(spark, root, "block=")
    if not blocks:
        return None
    fields = "n_rows long, t_min timestamp, t_max timestamp, block long, batch_id long"
    return (spark.read.schema(fields).option("basePath", root).parquet(*[f"{root}/block={b}" for b in blocks])
            .select("batch_id", "n_rows", "t_min", "t_max"))


def newest_batches(spark: SparkSession, path: str, n: int) -> list[int] | None:
    """The newest batches that hold at least ``n`` rows together, newest first; None for a table without a manifest.

    Blocks are read from the newest one backwards, ``BLOCK`` rows at a time.
    """
    blocks = _folders(spark, f"{path.rstrip('/')}/{MANIFEST}", "block=")
    if not blocks:
        return None
    have, found = 0, []
    for block in reversed(blocks):
        for r in manifest(spark, path, [block]).where("n_rows > 0").orderBy(F.desc("batch_id")).collect():
            found.append(r["batch_id"])
            have += r["n_rows"]
            if have >= n:
                return found
    return found


def batches_after(spark: SparkSession, path: str, after: int | None, upto: int) -> list[int] | None:
    """The batches with rows after batch ``after`` (None: all) up to ``upto``, from the manifest."""
    blocks = _folders(spark, f"{path.rstrip('/')}/{MANIFEST}", "block=")
    if not blocks:
        return None
    blocks = [b for b in blocks if b * BLOCK <= upto and (after is None or (b + 1) * BLOCK > after)]
    if not blocks:
        return []
    wanted = (F.col("batch_id") <= upto) & (F.lit(True) if after is None else F.col("batch_id") > F.lit(after))
    return sorted(r["batch_id"] for r in manifest(spark, path, blocks).where(wanted & (F.col("n_rows") > 0)).collect())


def read_batches(spark: SparkSession, path: str, ids: list[int], anomalies: bool = False) -> DataFrame:
    """The rows of the batches ``ids``; no other partition is listed or opened."""
    if not ids:
        schema = ANOMALY_SCHEMA if anomalies else RECORD_SCHEMA
        return _empty(spark, StructType(schema.fields + HISTORY_FIELDS))
    root = path.rstrip("/")
    df = spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={i}" for i in ids])
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def last_n(spark: SparkSession, path: str, n: int = 2000, anomalies: bool = False) -> DataFrame:
    """The newest ``n`` rows by arrival of the table under ``path``, by its manifest where it has one."""
    ids = newest_batches(spark, path, n)
    hist = read_history(spark, path, anomalies) if ids is None else read_batches(spark, path, ids, anomalies)
    return history_last_n(hist, n, prune=ids is None)


def _empty(spark: SparkSession, schema) -> DataFrame:
    return local_table(spark, [], schema)


def missing(exc: AnalysisException) -> bool:
    """Whether the error says that nothing has been written yet; any other one is a fault."""
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_history(spark: SparkSession, path: str, anomalies: bool = False) -> DataFrame:
    """The table under ``path``; before its first batch, an empty table with all its columns."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if not missing(exc):
            raise
        schema = ANOMALY_SCHEMA if anomalies else RECORD_SCHEMA
        return _empty(spark, StructType(schema.fields + HISTORY_FIELDS))


def newest_batches_cutoff(hist: DataFrame, n: int) -> int | None:
    """Smallest batch id such that the batches from it on hold at least ``n`` rows.

    Doubling search from the newest batch id: each probe is a count over a
    partition-pruned range, and only the per-batch counts of the final range
    (about as many batches as the last ``n`` rows span) reach the driver. For
    tables without a manifest; the ids come from the partition column alone.
    """
    b = F.col("batch_id")
    r = hist.agg(F.min(b).alias("a"), F.max(b).alias("z")).first()
    if r["z"] is None:
        return None
    width = 1
    while width <= r["z"] - r["a"] and hist.where(b > F.lit(r["z"] - width)).count() < n:
        width *= 2
    counts = hist.where(b > F.lit(r["z"] - width)).groupBy("batch_id") \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("batch_id")).collect()
    acc = 0
    for row in counts:
        acc += row["n"]
        if acc >= n:
            return row["batch_id"]
    return None


def compact(spark: SparkSession, path: str, into: str, *, keep_from: int | None = None,
            batch_size: int = 1000) -> None:
    """Rewrite the history under ``path`` to ``into`` with few files, one partition per ``batch_size`` batches.

    ``batch_id`` becomes the first batch of its range, so "last N" reads keep
    their order between ranges and use time inside one. ``keep_from`` leaves
    older batches out (retention). Readers switch to ``into`` once it is written.
    """
    hist = read_history(spark, path)
    if keep_from is not None:
        hist = hist.where(F.col("batch_id") >= F.lit(keep_from))
    ranged = hist.withColumn("batch_id", (F.floor(F.col("batch_id") / batch_size) * batch_size).cast("bigint"))
    ranged.repartition("batch_id", F.pmod(F.col("row_hash"), F.lit(16))) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(into)
    _record_all(spark.read.parquet(into), into)


def history_last_n(hist: DataFrame, n: int = 2000, *, prune: bool = True) -> DataFrame:
    """The newest ``n`` rows by arrival (batch, then time, city, hash).

    With ``prune`` only the newest batches that can contain those rows are read
    (partition pruning on ``batch_id``), so the final top-n merges rows of a
    few partitions instead of n rows from every partition of the history.
    """
    src = hist
    if prune and "batch_id" in hist.columns:
        cutoff = newest_batches_cutoff(hist, n)
        if cutoff is not None:
            src = hist.where(F.col("batch_id") >= F.lit(cutoff))
    return src.orderBy(*[F.desc_nulls_last(c) for c in ARRIVAL_ORDER]).limit(n)


def records_scan(spark: SparkSession, path: str, *, fmt: str = "parquet",
                 descending: bool = False, sort: bool = True, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    """Read a record table, coerce ``timestamp`` to UTC time (bad -> NULL), sort by time.

    ``fmt="json"`` reads JSON arrays/lines with the fixed ``schema``.
    Missing data gives an empty frame with the schema. The sort is a
    range-partitioned global sort; pass ``sort=False`` when the consumer
    aggregates or filters anyway.
    """
    try:
        if fmt == "json":
            df = spark.read.schema(schema).option("multiLine", "true").json(path)
        else:
            df = spark.read.parquet(path)
    except AnalysisException as exc:
        if not missing(exc):
            raise
        df = _empty(spark, schema)
    df = df.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))
    if not sort:
        return df
    order = F.desc_nulls_last("event_time") if descending else F.asc_nulls_last("event_time")
    return df.orderBy(order, F.asc_nulls_last("city"))


def anomaly_scan(spark: SparkSession, path: str, *, fmt: str = "parquet", sort: bool = True) -> DataFrame:
    """The anomaly history (records with label, score and flag), newest first."""
    return records_scan(spark, path, fmt=fmt, descending=True, sort=sort, schema=ANOMALY_SCHEMA)


def write_window_rows(aggs: DataFrame, path: str) -> None:
    """Window rows as JSON lines (NULL fields are left out of each line)."""
    aggs.write.mode("overwrite").json(path)


def agg_scan(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All window rows under ``path`` (JSON lines or Parquet, any number of files), by window start.

    The explicit schema keeps columns that some files omit (NULL stddev). A
    directory written by a streaming file sink is read through its commit log.
    """
    try:
        df = spark.read.schema(WINDOW_AGG_SCHEMA).format(fmt).load(path)
    except AnalysisException as exc:
        if not missing(exc):
            raise
        df = _empty(spark, WINDOW_AGG_SCHEMA)
    return df.orderBy("window_start", "city")
