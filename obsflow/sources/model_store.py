"""Versioned model store: forest nodes, feature statistics, metadata, commit log.

A version is written whole (three small Parquet tables partitioned by
``version``, dynamic overwrite, so re-writing a version replaces it) and then
committed by appending one row to ``commits``. Readers take the newest
committed version; a store without commits means "no model yet", any other
fault is raised.

Pruning never changes a table in place. It writes the versions to keep into a
new folder ``generation-K``, then commits it by appending K to ``generations``;
from then on readers and writers use that folder, and only then the one before
it is removed. Wherever it stops, the newest generation that is committed is
whole.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from obsflow.operators import forest as iforest
from obsflow.operators.anomalies import Model
from obsflow.schemas import FOREST_NODE_SCHEMA
from obsflow.sources.history import missing
from obsflow.sources.tables import local_table


def _generation(spark: SparkSession, root: str) -> int | None:
    """The newest committed generation; None for a store that was never pruned."""
    try:
        return spark.read.schema("generation long").parquet(f"{root}/generations").agg(F.max("generation").alias("g")).first()["g"]
    except AnalysisException as exc:
        if missing(exc):
            return None
        raise


def current(spark: SparkSession, root: str) -> str:
    """The folder that holds the store's tables now."""
    root = root.rstrip("/")
    g = _generation(spark, root)
    return root if g is None else f"{root}/generation-{g}"


def save_model(spark: SparkSession, model: Model, root: str, version: int, nodes_df=None) -> None:
    """Write version ``version`` of the model, then commit it."""
    root = current(spark, root)
    if nodes_df is None:
        nodes_df = local_table(spark, model.forest.extra["nodes"], FOREST_NODE_SCHEMA)
    w = lambda df, name: (df.withColumn("version", F.lit(int(version)))
                          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                          .partitionBy("version").parquet(f"{root}/{name}"))
    w(nodes_df, "nodes")
    stats = [(f, int(s["n"]), s["median"], s["mean"], s["std_pop"]) for f, s in model.stats.items()]
    w(local_table(spark, stats, "feature string, n bigint, median double, mean double, std_pop double")
      .withColumn("position", F.monotonically_increasing_id()), "stats")
    meta = [(model.threshold, int(model.forest.psi), int(model.n_train), ",".join(model.features))]
    w(local_table(spark, meta, "threshold double, psi int, n_train bigint, features string"), "meta")
    local_table(spark, [(int(version),)], "version int") \
        .withColumn("committed_at", F.current_timestamp()) \
        .write.mode("append").parquet(f"{root}/commits")


def _commits(spark: SparkSession, root: str):
    """The commit log, or None while nothing has been committed; a storage fault is raised."""
    try:
        return spark.read.parquet(f"{current(spark, root)}/commits")
    except AnalysisException as exc:
        if missing(exc):
            return None
        raise


def latest_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Newest committed version (below ``before`` when given); one aggregate row."""
    c = _commits(spark, root)
    if c is None:
        return None
    if before is not None:
        c = c.where(F.col("version") < F.lit(int(before)))
    return c.agg(F.max("version").alias("v")).first()["v"]


def is_committed(spark: SparkSession, root: str, version: int) -> bool:
    c = _commits(spark, root)
    return c is not None and not c.where(F.col("version") == F.lit(int(version))).isEmpty()


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """All committed versions (for operators of the store; loading a model never lists them)."""
    c = _commits(spark, root)
    return [] if c is None else sorted(r["version"] for r in c.select("version").distinct().collect())


def load_nodes(spark: SparkSession, root: str, version: int):
    return spark.read.parquet(f"{current(spark, root)}/nodes").where(F.col("version") == version).drop("version")


def load_model(spark: SparkSession, root: str, version: int | None = None) -> Model | None:
    """The newest committed model (or committed ``version``); None while there is none."""
    v = latest_version(spark, root) if version is None else version
    if v is None or (version is not None and not is_committed(spark, root, version)):
        return None
    store, root = root, current(spark, root)
    meta = spark.read.parquet(f"{root}/meta").where(F.col("version") == v).first()
    stats_rows = spark.read.parquet(f"{root}/stats").where(F.col("version") == v).orderBy("position").collect()
    feats = meta["features"].split(",") if meta["features"] else []
    stats = {r["feature"]: {"feature": r["feature"], "n": r["n"], "median": r["median"],
                            "mean": r["mean"], "std_pop": r["std_pop"]} for r in stats_rows}
    nodes = load_nodes(spark, store, v).collect()  # bounded: trees * (2 psi - 1)
    forest = iforest.Forest.from_nodes(nodes, [f"__z_{f}" for f in feats], meta["psi"])
    forest.extra["nodes"] = [tuple(r) for r in nodes]
    return Model(feats, {f: stats[f] for f in feats}, forest, meta["threshold"], meta["n_train"], v)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def prune_versions(spark: SparkSession, root: str, keep: int = 10) -> list[int]:
    """Drop all but the newest ``keep`` committed versions from the store; returns the versions that stay.

    Run it while no writer is active. A run that stops half way leaves the
    store as it was, or as it is to be, and the next run starts afresh.
    """
    c = _commits(spark, root)
    if c is None:
        return []
    kept = [r["version"] for r in c.select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()]
    root = root.rstrip("/")
    old, g = current(spark, root), _generation(spark, root)
    new = f"{root}/generation-{0 if g is None else g + 1}"
    for name in ("nodes", "stats", "meta", "commits"):
        left = spark.read.parquet(f"{old}/{name}").where(F.col("version").isin(kept))
        w = left.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy("version") if name != "commits" else w).parquet(f"{new}/{name}")
    _commit_generation(spark, root, 0 if g is None else g + 1)
    for name in ("nodes", "stats", "meta", "commits"):
        _remove(spark, f"{old}/{name}")
    return sorted(kept)


def _commit_generation(spark: SparkSession, root: str, generation: int) -> None:
    local_table(spark, [(generation,)], "generation long").write.mode("append").parquet(f"{root}/generations")
