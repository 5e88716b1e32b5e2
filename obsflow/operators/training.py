"""Incremental training: a state that batches are merged into and a forest is fitted from.

The state of a history is small and mergeable, and the state of two parts joined
equals the state of both together:

* ``samples`` -- per tree the rows with the ``psi`` smallest draws. A row's
  draws for all trees follow from its key alone: sorted, they are the arrival
  times of ``n_trees`` independent unit exponentials (the first is an
  exponential at rate ``n_trees``, one hash), dealt to the trees in an order
  hashed from the key. So one hash per row tells nearly all rows of a large batch
  that they enter no tree, and only the rest draw all their times.
* ``rows`` -- the features of every row. The threshold is a quantile of all their
  scores, and a new forest gives each of them a new score. They stand as tree -1
  of ``samples``; a caller may ask for the ``calibration`` smallest draws instead.
* ``values`` -- how often each value of each feature occurred, for exact
  medians, means and deviations. It grows with the distinct values: sensor
  readings have a fixed resolution and a bounded range, so it stops growing.
* ``n_rows``.

Rows are named by their key columns; without any, copies are numbered within a
batch (``salt`` keeps equal rows of different batches apart).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.functions.numeric import COLLECTED, SNAP, exact_quantile, exact_quantiles, finite_or_null, picked, snapped
from obsflow.operators import features as feat
from obsflow.operators import forest as iforest
from obsflow.operators.anomalies import MIN_SAMPLES, Model, row_key, usable_features
from obsflow.operators.scoring import CONTAMINATION
from obsflow.sources.tables import local_table

SAMPLE_COLUMNS = ["tree_id", "draw", "h"]
_UNIT = float(1 << 53)


@dataclass
class TrainingState:
    drawn: DataFrame        # tree_id int, draw double, h long, one double per feature (null: missing)
    values: DataFrame       # feature string, value double, n long
    n_rows: int
    features: list[str]
    rows: DataFrame | None = None   # one double per feature (null: missing); None where a caller bounded tree -1
    fresh: DataFrame | None = None  # those of ``rows`` that no part of the store holds yet
    parts: dict[str, int] = field(default_factory=dict)  # the parts that hold the others, and how many rows each

    @property
    def samples(self) -> DataFrame:
        """The rows of each tree and, as tree -1, those whose scores set the threshold."""
        if self.rows is None:
            return self.drawn
        return self.drawn.unionByName(self.rows.withColumn("tree_id", F.lit(-1)), allowMissingColumns=True)


def _first_draw(n: int, lane: int, seed: int) -> F.Column:
    """The smallest of ``n`` unit exponentials of the row with key hash ``h``."""
    u = (F.pmod(F.xxhash64(F.col("h"), F.lit(seed), F.lit(lane)), F.lit(1 << 53)).cast("double") + 1) / _UNIT
    return -F.log(u) / n


def _mixed(h: np.ndarray, lane: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes (rows, lanes) of the key hashes."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64)[:, None] + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ ((lane.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))[None, :]
        for shift in (32, 29):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def draws(h: np.ndarray, first: np.ndarray, n_trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(tree, draw), both (rows, n_trees): each row's draws in ascending order and the trees they go to."""
    lanes = np.arange(n_trees)
    step = -np.log(((_mixed(h, lanes[1:], seed) >> np.uint64(11)).astype(float) + 1) / _UNIT) / (n_trees - lanes[1:])
    times = np.concatenate([first[:, None], step], axis=1).cumsum(axis=1)
    order = np.argsort(_mixed(h, lanes + (1 << 20), seed), axis=1, kind="stable")
    return order, times


def _dealer(n_trees: int, bound: float, seed: int):
    """Rows (h, first draw, features) to one row per tree whose draw is below ``bound``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                h = part.column(0).to_numpy()
                tree, time = draws(h, part.column(1).to_numpy(), n_trees, seed)
                r, j = np.nonzero(time < bound)
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree[r, j], pa.int32()), pa.array(time[r, j]), part.column(0).take(at),
                     *[part.column(c).take(at) for c in range(2, part.num_columns)]],
                    [*SAMPLE_COLUMNS, *part.schema.names[2:]])
    return run


def _bound(want: int, n: int) -> float:
    """A draw below which ``n`` rows have ``want`` draws, nearly surely: a little above want / n."""
    share = (want + 6.0 * math.sqrt(want) + 16.0) / n
    return math.inf if n <= want or share >= 1 else -math.log1p(-share)


def _smallest(samples: DataFrame, psi: int, calibration: int | None) -> DataFrame:
    w = Window.partitionBy("tree_id").orderBy("draw", "h")
    limit = F.when(F.col("tree_id") < 0, F.lit(calibration)).otherwise(F.lit(psi))
    most = max(psi, calibration or 0)
    return (samples.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= most)  # a group limit for Spark
            .where(F.col("__rn") <= limit).drop("__rn"))


def merged(state: TrainingState | None, batch: DataFrame, *, features: list[str] = feat.FEATURES,
           key_cols: list[str] | None = None, n_trees: int = iforest.N_TREES, max_samples: int = iforest.MAX_SAMPLES,
           calibration: int | None = None, seed: int = iforest.SEED, salt: int | None = None) -> TrainingState:
    """The state of the rows of ``state`` and of ``batch``; plans only, apart from counts. Reads the two, nothing else.

    All rows set the threshold, unless a caller bounds them to ``calibration``, in every merge alike.
    """
    feats = state.features if state is not None else feat.available(batch, features)
    if state is not None and feats and (state.rows is None) != (calibration is not None):
        raise ValueError("a state with a bound on the rows of its threshold and one without cannot be merged")
    keys = row_key(batch) if key_cols is None else key_cols
    clean = batch.select(*keys, *[finite_or_null(f).alias(f) for f in feats])
    rows = iforest.keyed_rows(clean, feats, keys).withColumnRenamed("__h", "h")
    if salt is not None and not keys:
        rows = rows.withColumn("h", F.xxhash64("h", F.lit(salt)))
    n = clean.count() + (0 if state is None else state.n_rows)
    counted = clean.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in feats]))
                           .alias("s")).select("s.*").where("value is not null") \
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")) if feats else None
    schema = f"tree_id int, draw double, h long{''.join(f', `{f}` double' for f in feats)}"

    def drawn(bound: float, cal_bound: float) -> DataFrame:
        first, cal = _first_draw(n_trees, 0, seed), _first_draw(1, -2, seed)
        both = rows.select("h", first.alias("first"), *feats).where(F.col("first") < bound) \
            .mapInArrow(_dealer(n_trees, bound, seed), schema)
        if calibration is not None:
            both = both.unionByName(rows.select(F.lit(-1).alias("tree_id"), cal.alias("draw"), "h", *feats)
                                    .where(F.col("draw") < cal_bound))
        return both if state is None else both.unionByName(state.drawn.select(*both.columns))

    grow = 1
    while True:
        bound, cal_bound = (_bound(k * grow, n) if n and k is not None else math.inf for k in (max_samples, calibration))
        samples = _smallest(drawn(bound, cal_bound), max_samples, calibration).persist()
        # complete if every tree is full of draws below its bound (or nothing was held back)
        worst = samples.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n"), F.max("draw").alias("d")).collect()
        full = {r["tree_id"]: r["n"] >= (calibration if r["tree_id"] < 0 else max_samples)
                and r["d"] < (cal_bound if r["tree_id"] < 0 else bound) for r in worst}
        trees_done = math.isinf(bound) or all(full.get(t, False) for t in range(n_trees))
        if trees_done and (math.isinf(cal_bound) or full.get(-1, False)):
            break
        samples.unpersist()
        grow *= 2
    if state is not None and counted is not None:
        counted = counted.unionByName(state.values).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    if counted is None:
        counted = local_table(batch.sparkSession, [], "feature string, value double, n long")
    if calibration is not None or not feats:
        return TrainingState(samples, counted, n, feats)
    every = fresh = clean.select(*feats)
    if state is not None:
        every = state.rows.unionByName(every)
        fresh = fresh if state.fresh is None else state.fresh.unionByName(fresh)
    return TrainingState(samples, counted, n, feats, every, fresh, {} if state is None else state.parts)


def _medians(values: DataFrame, feats: list[str]) -> dict[str, float | None]:
    """Exact medians of counted values: on the driver up to ``COLLECTED`` distinct ones, else narrowed by jobs."""
    few = values.limit(COLLECTED + 1).collect()
    if len(few) > COLLECTED:
        wide = values.select(*[F.when(F.col("feature") == f, F.col("value")).alias(f) for f in feats], "n")
        return exact_quantiles(wide, feats, 0.5, weight="n")
    cells = {f: [(r["value"], r["n"]) for r in few if r["feature"] == f] for f in feats}
    return {f: picked(c, sum(n for _, n in c), 0.5) if c else None for f, c in cells.items()}


def state_stats(state: TrainingState) -> dict[str, dict]:
    """n, median, mean and population deviation per feature, equal to ``features.feature_stats`` of all rows."""
    feats = state.features
    med = {f: None if m is None else round(m, SNAP) for f, m in _medians(state.values, feats).items()}
    median = F.element_at(F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(med[f]).cast("double"))]), F.col("feature"))
    total, n = F.lit(float(state.n_rows)), F.sum("n")
    base = state.values.groupBy("feature").agg(n.alias("n"), F.sum(F.col("value") * F.col("n")).alias("s"))
    mean = (F.col("s") + (total - F.col("n")) * median) / total
    base = base.withColumn("mean", mean).withColumn("med", median).withColumnRenamed("n", "have")
    off = state.values.join(F.broadcast(base), "feature").groupBy("feature", "have", "mean", "med").agg(  # one row a feature
        F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)).alias("ss"))
    var = (F.col("ss") + (total - F.col("have")) * F.pow(F.col("med") - F.col("mean"), 2)) / total
    got = {r["feature"]: r for r in off.select("feature", "have", snapped(F.col("mean"), 6).alias("mean"),
                                               F.round(F.sqrt(var), 6).alias("std")).collect()}
    none = {"have": 0, "mean": None, "std": None}
    return {f: {"feature": f, "n": got.get(f, none)["have"], "median": med[f], "mean": got.get(f, none)["mean"],
                "std_pop": got.get(f, none)["std"]} for f in feats}


def fit_state(state: TrainingState, *, n_trees: int = iforest.N_TREES, max_samples: int = iforest.MAX_SAMPLES,
              seed: int = iforest.SEED, contamination: float = CONTAMINATION, version: int = 0) -> Model | None:
    """Scaler, forest and threshold from the state alone; None below five rows or without a usable feature.

    The threshold is the exact quantile of the scores of all rows, each scored once.
    """
    if state.n_rows < MIN_SAMPLES or not state.features:
        return None
    stats = state_stats(state)
    feats = usable_features(stats)
    if not feats:
        return None
    zcols = [f"__z_{f}" for f in feats]
    z = feat.standardize(state.samples, stats, prefix="__z_", features=feats)
    psi = min(max_samples, state.n_rows)
    trees = z.where("tree_id >= 0").select("tree_id", F.col("draw").alias("__r"), F.col("h").alias("__h"), *zcols)
    nodes = trees.groupBy("tree_id").applyInPandas(iforest._builder(zcols, psi, seed), iforest.FOREST_NODE_SCHEMA).collect()
    forest = iforest.Forest.from_nodes(nodes, zcols, psi)  # trees * (2 psi - 1) rows at most
    forest.extra["nodes"] = sorted(tuple(r) for r in nodes)
    scored = iforest.score(z.where("tree_id < 0").select(*zcols), forest).select("anomaly_score_raw").persist()
    threshold = exact_quantile(scored, "anomaly_score_raw", contamination)
    scored.unpersist()
    return Model(feats, {f: stats[f] for f in feats}, forest, threshold, state.n_rows, version)
