"""Isolation forest fitted and applied on the executors.

After Liu, Ting and Zhou, "Isolation Forest" (ICDM 2008):

* **Sampling** -- each tree gets psi = min(max_samples, n) rows without
  replacement out of all rows. Every row has a key (its id columns, else its
  values and, for equal rows, the number of the copy), and all draws are hashes
  of that key: how many trees take the row (a binomial count, zero for nearly
  all rows of a large table), which ones, and its order in each tree. So one
  scan without a shuffle selects about 1.4 psi rows a tree, whatever the size
  and the partitioning of the input, and the same rows give the same forest. The
  psi first rows of each tree are kept; a tree that got fewer is redrawn at a
  higher rate.
* **Building** -- ``groupBy(tree_id).applyInPandas``: one bounded group per
  tree; random non-constant feature, uniform threshold, depth limit
  ceil(log2(psi)); a split with an empty side makes a leaf.
* **Scoring** -- a scalar Arrow UDF over the feature columns only; the node
  arrays (at most trees * (2 psi - 1) rows, checked by size) are broadcast, laid
  out level by level and walked with numpy. Works
  unchanged on a stream.

score(x) = -2 ** (-mean_t h_t(x) / c(psi)), h = leaf depth + c(leaf rows),
c(1) = 0, c(2) = 1, c(n) = 2 (ln(n - 1) + gamma) - 2 (n - 1) / n.
Lower is more anomalous.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from obsflow.schemas import FOREST_NODE_SCHEMA
from obsflow.sources.tables import local_table

# ---- Fixed values: forest parameters -----------------------------------------
N_TREES = 100
MAX_SAMPLES = 256
SEED = 42
#: What the arrays of a broadcast forest may take; checked before it is laid out.
MAX_BYTES = 1 << 30
# ------------------------------------------------------------------------------
EULER_GAMMA = 0.5772156649015329


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


@dataclass
class Forest:
    """Node arrays of a fitted forest (small: at most trees * (2 psi - 1) nodes)."""
    features: list[str]
    psi: int
    feature: np.ndarray      # per slot: the feature of a split, 0 at a leaf
    threshold: np.ndarray    # per slot, NaN at a leaf
    child: np.ndarray        # per slot: the left child (the right one follows), the slot before a leaf itself
    leaf_h: np.ndarray       # per slot: depth + c(n_rows)
    root: np.ndarray         # per tree: its first slot
    depth: np.ndarray        # per tree: its depth
    n_nodes: int = 0
    extra: dict = field(default_factory=dict)

    def __getstate__(self):
        # the broadcast handle stays on the driver; executors get arrays only
        state = dict(self.__dict__)
        state["extra"] = {k: v for k, v in self.extra.items() if k != "broadcast"}
        return state

    @staticmethod
    def from_nodes(rows: list, features: list[str], psi: int) -> "Forest":
        pdf = pd.DataFrame([r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows],
                           columns=[f.name for f in FOREST_NODE_SCHEMA.fields])
        if 32 * len(pdf) > MAX_BYTES:
            raise ValueError(f"a forest of {len(pdf)} nodes is beyond {MAX_BYTES} bytes; lower max_samples or n_trees")
        return Forest._laid_out(pdf, features, psi)

    @staticmethod
    def _laid_out(pdf: pd.DataFrame, features: list[str], psi: int) -> "Forest":
        """All trees in one run of slots: level by level, roots first, the two children of a node side by side.

        A step is ``slot = child + (x > threshold)``. A leaf has a threshold that
        no value is below and a child one before itself, so a row that has
        arrived stays: memory goes with the nodes, whatever the depth.
        """
        pdf = pdf.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        col = lambda name, kind=np.int64: pdf[name].to_numpy(dtype=kind)
        n, tree, feature = len(pdf), col("tree_id"), col("feature")
        key = tree << 32 | col("node_id")
        level = np.flatnonzero(col("node_id") == 0)
        levels, inner, kids = [level], [], []
        while level.size:
            split = level[feature[level] >= 0]
            level = np.searchsorted(key, np.stack([tree[split] << 32 | col(c)[split] for c in ("left", "right")], 1)).ravel()
            levels.append(level)
            inner.append(split)
            kids.append(level[::2])
        order = np.concatenate(levels)
        slot = np.empty(n, dtype=np.int64)
        slot[order] = np.arange(n)
        parent, first = np.concatenate(inner or [order]), np.concatenate(kids or [order])
        feat, child, thr = np.zeros(n, dtype=np.int64), np.arange(-1, n - 1), np.full(n, np.nan)
        child[slot[parent]] = slot[first]
        feat[slot[parent]] = feature[parent]
        thr[slot[parent]] = col("threshold", float)[parent]
        path = (col("depth") + c_factor(col("n_rows")))[order]
        depths = pdf.groupby("tree_id")["depth"].max().to_numpy(dtype=np.int64)
        return Forest(features, psi, feat, thr, child, path, np.arange(len(depths)), depths, n)

    def path_lengths(self, X: np.ndarray) -> np.ndarray:
        """Sum over trees of h(x), accumulated tree by tree (a plain left-to-right sum).

        One tree at a time over the whole batch (1-D gathers stay in cache);
        ``x <= threshold`` goes left, so NaN goes right.
        """
        n, d = X.shape
        flat = np.ascontiguousarray(X, dtype=float).ravel()
        base = np.arange(n, dtype=np.int64) * d
        total = np.zeros(n)
        for root, depth in zip(self.root.tolist(), self.depth.tolist(), strict=True):
            node = np.full(n, root, dtype=np.int64)
            for _ in range(depth):
                x = flat.take(base + self.feature.take(node))
                node = self.child.take(node) + 1 - (x <= self.threshold.take(node))
            total += self.leaf_h.take(node)
        return total

    def score(self, X: np.ndarray) -> np.ndarray:
        mean_h = self.path_lengths(X) / max(len(self.root), 1)
        return -np.power(2.0, -mean_h / float(c_factor([self.psi])[0]))


# ---------------------------------------------------------------------------
# Sampling
# ---------------------------------------------------------------------------
def _unit(*cols) -> F.Column:
    """Uniform [0, 1) value from a hash of the columns."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53)))


def _binomial_tail(n: int, p: float) -> list[float]:
    """P(K >= j) for j = 1, 2, ... of a binomial count, as far as it is above 1e-18."""
    log_pmf = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
               + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(n + 1)]
    out, acc = [0.0] * (n + 1), 0.0
    for k in range(n, 0, -1):
        acc += math.exp(log_pmf[k])
        out[k] = min(1.0, acc)
    return [x for x in out[1:] if x > 1e-18]


def keyed_rows(df: DataFrame, features: list[str], key_cols: list[str], copies: int = 1_000_000) -> DataFrame:
    """The features and a key hash ``__h`` per row, independent of order and partitioning.

    ``key_cols`` name a row. Without them equal rows are counted and numbered:
    the numbers of a group of copies are produced in chunks of ``copies`` that
    are dealt out, so copies of any number stay spread.
    """
    cols = [F.col(f).cast("double").alias(f) for f in features]
    if key_cols:
        return df.select(*cols, F.xxhash64(*key_cols).alias("__h"))
    counted = df.select(*cols).groupBy(*features).agg(F.count(F.lit(1)).alias("n"))
    chunks = counted.withColumn("c", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {copies}"))))
    rows = chunks.repartition(*features, "c").withColumn("i", F.explode(F.sequence(
        F.expr(f"c * {copies}"), F.expr(f"least(n, (c + 1) * {copies}) - 1"))))
    return rows.select(*features, F.xxhash64(*features, "i").alias("__h"))


def tree_samples(rows: DataFrame, features: list[str], n: int, psi: int, *, n_trees: int = N_TREES,
                 seed: int = SEED, rate_boost: float = 1.0) -> DataFrame:
    """(tree_id, __r, features) pairs, about 1.4 * psi per tree, from ``keyed_rows``."""
    rate = 1.0 if n <= psi else min(1.0, rate_boost * (psi + 6.0 * math.sqrt(psi) + 16.0) / n)
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    h = F.col("__h")
    if rate < 1.0:
        tail = _binomial_tail(n_trees, rate)
        u = _unit(h, F.lit(seed), F.lit(-1))
        rows = rows.where(u < F.lit(tail[0]))   # the gate: one hash per row, before anything else
        many = F.size(F.filter(F.array(*[F.lit(t) for t in tail]), lambda t: u < t))
        order = F.array_sort(F.transform(trees, lambda t: F.struct(F.xxhash64(h, F.lit(seed), t).alias("o"), t.alias("t"))))
        trees = F.transform(F.slice(order, 1, many), lambda s: s["t"])
    return rows.select("__h", *features, F.explode(trees).alias("tree_id")) \
        .withColumn("__r", F.xxhash64(h, F.lit(seed), F.col("tree_id"), F.lit(7)))


# ---------------------------------------------------------------------------
# Building
# ---------------------------------------------------------------------------
def _build_one(tree_id: int, X: np.ndarray, psi: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree_id])
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    nodes: list[list] = []
    stack = [(np.arange(X.shape[0]), 0, -1, 0)]  # rows, depth, parent, side
    while stack:
        idx, depth, parent, side = stack.pop()
        nid = len(nodes)
        nodes.append([tree_id, nid, -1, None, -1, -1, depth, int(idx.size)])
        if parent >= 0:
            nodes[parent][4 if side == 0 else 5] = nid
        if depth >= max_depth or idx.size <= 1:
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            continue
        f = int(cand[rng.integers(cand.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        if go_left.all() or not go_left.any():
            continue
        nodes[nid][2], nodes[nid][3] = f, thr
        stack.append((idx[~go_left], depth + 1, nid, 1))
        stack.append((idx[go_left], depth + 1, nid, 0))
    return [tuple(r) for r in nodes]


def _builder(features: list[str], psi: int, seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__r", "__h", *features], kind="mergesort").head(psi)
        tree_id = int(pdf["tree_id"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        rows = _build_one(tree_id, X, psi, seed)
        return pd.DataFrame(rows, columns=[f.name for f in FOREST_NODE_SCHEMA.fields])
    return build


def fit_nodes(df: DataFrame, features: list[str], key_cols: list[str] | None = None, *, n_trees: int = N_TREES,
              max_samples: int = MAX_SAMPLES, seed: int = SEED, n_rows: int | None = None) -> tuple[DataFrame, int]:
    """Fit a forest on all rows; returns (nodes DataFrame, psi). Only node rows are materialised."""
    rows = keyed_rows(df, features, [c for c in key_cols or [] if c in df.columns])
    n = df.count() if n_rows is None else n_rows
    psi = min(max_samples, n)
    if psi == 0:
        return local_table(df.sparkSession, [], FOREST_NODE_SCHEMA), 0
    boost = 1.0
    for _ in range(6):
        pairs = tree_samples(rows, features, n, psi, n_trees=n_trees, seed=seed, rate_boost=boost)
        nodes = pairs.groupBy("tree_id").applyInPandas(_builder(features, psi, seed), FOREST_NODE_SCHEMA).persist()
        roots = nodes.where(F.col("node_id") == 0).agg(
            F.count(F.lit(1)).alias("t"), F.min("n_rows").alias("mn")).first()
        if roots["t"] == n_trees and roots["mn"] == psi:
            return nodes, psi
        nodes.unpersist()
        boost *= 1.5
    raise RuntimeError("could not draw full tree samples")


def literal_nodes(spark, trees: list[list[tuple]]) -> DataFrame:
    """Nodes DataFrame from literal rows (tree_id, node_id, feature, threshold, left, right, depth, n_rows)."""
    return local_table(spark, [r for t in trees for r in t], FOREST_NODE_SCHEMA)


# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------
def score_column(spark, forest: Forest, cols: list[str]) -> F.Column:
    """The isolation score as a column: a scalar Arrow UDF over the feature columns only.

    Only the feature values cross to Python (Arrow batches); every other column
    of the row stays in the JVM. The forest (bounded) travels as a broadcast.
    Declared nondeterministic although it is not: a filter on the score is then
    not pushed below it as a second evaluation, which would take a second Python
    worker per task.
    """
    bc = forest.extra.get("broadcast")
    if bc is None:  # one broadcast per forest, reused by every micro-batch that scores with it
        bc = spark.sparkContext.broadcast(forest)
        forest.extra["broadcast"] = bc

    @F.arrow_udf(DoubleType())
    def isolation_score(*features: pa.Array) -> pa.Array:
        X = np.column_stack([f.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) for f in features]) \
            if len(features[0]) else np.zeros((0, len(features)))
        return pa.array(bc.value.score(X) if len(X) else np.zeros(0), from_pandas=True)  # NaN is null

    return isolation_score.asNondeterministic()(*[F.col(c) for c in cols])


def score(df: DataFrame, forest: Forest, feature_cols: list[str] | None = None,
          out: str = "anomaly_score_raw") -> DataFrame:
    """Append the isolation score of ``feature_cols`` (default: the forest's features)."""
    cols = feature_cols or forest.features
    return df.withColumn(out, score_column(df.sparkSession, forest, cols))


def round4(c) -> F.Column:
    """Round half to even at 4 places, on the binary value (numpy's rule)."""
    return F.rint(c * F.lit(10000.0)) / F.lit(10000.0)
