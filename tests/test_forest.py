import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.functions.numeric import exact_quantile
from obsflow.operators import anomalies as anom
from obsflow.operators import features as feat
from obsflow.operators import forest as iforest
from obsflow.operators.quality import clean_records
from obsflow.schemas import RECORD_SCHEMA
from obsflow.sources import model_store
from obsflow.sources.tables import weather_view
from obsflow.session import work_dir
from tests.conftest import SF001, rec

SMALL = dict(n_trees=20)


@pytest.fixture(scope="module")
def clean(spark):
    return clean_records(weather_view(spark, SF001)).persist()


@pytest.fixture(scope="module")
def model(clean):
    return anom.fit_model(clean, **SMALL)


def _scores(df, m):
    return {r["event_id"]: r["anomaly_score"] for r in anom.apply_model(df, m).select("event_id", "anomaly_score").collect()}


def test_forest_is_deterministic(clean, model):
    m2 = anom.fit_model(clean, **SMALL)
    assert sorted(model.forest.extra["nodes"]) == sorted(m2.forest.extra["nodes"])
    assert _scores(clean, model) == _scores(clean.repartition(3), m2)   # scoring never depends on layout


def test_scores_range_and_flag_count(clean, model):
    scored = anom.apply_model(clean, model)
    r = scored.agg(F.min("anomaly_score").alias("lo"), F.max("anomaly_score").alias("hi"),
                   F.sum(F.col("is_anomaly").cast("int")).alias("k"), F.count(F.lit(1)).alias("n"),
                   F.countDistinct("anomaly_score").alias("d")).first()
    assert -1.0 <= r["lo"] and r["hi"] < 0.0
    assert r["k"] <= math.ceil(0.05 * (r["n"] - 1))  # ties can only lower it
    assert r["k"] >= math.ceil(0.05 * (r["n"] - 1)) - (r["n"] - r["d"])


def test_spark_scores_equal_numpy_walk(spark, clean, model):
    pdf = feat.standardize(clean, model.stats, prefix="__z_", features=model.features).toPandas()
    X = pdf[[f"__z_{f}" for f in model.features]].to_numpy(float)
    # plain recursive walk of the node rows
    nodes = {}
    for r in model.forest.extra["nodes"]:
        nodes[(r[0], r[1])] = r
    trees = sorted({k[0] for k in nodes})

    def h(x, t):
        nid = 0
        while True:
            _, _, f, thr, le, ri, depth, n = nodes[(t, nid)]
            if f < 0:
                return depth + float(iforest.c_factor([n])[0])
            nid = le if x[f] <= thr else ri

    c = float(iforest.c_factor([model.forest.psi])[0])
    want = np.array([-(2.0 ** (-(sum(h(x, t) for t in trees) / len(trees)) / c)) for x in X])
    got = pdf.merge(anom.apply_model(clean, model).select("event_id", "anomaly_score").toPandas(), on="event_id")
    assert np.allclose(np.round(want, 4), got["anomaly_score"].to_numpy(), atol=1e-4)


def test_planted_outlier_ranks_lowest(spark, clean):
    extra = spark.createDataFrame([rec(city="Nowhere", temperature=59.0, humidity=0, pressure=870, wind_speed=400.0,
                                       clouds=100, visibility=1, timestamp="2024-01-15T00:00:00+00:00")], RECORD_SCHEMA) \
        .withColumn("event_time", F.try_to_timestamp("timestamp")).withColumn("event_id", F.lit(-1).cast("bigint"))
    df = clean.unionByName(extra)
    scored = anom.apply_model(df, anom.fit_model(df))   # 100 trees: the row is in ~30 samples
    lowest = scored.orderBy("anomaly_score").first()
    assert lowest["event_id"] == -1 and lowest["is_anomaly"]


def test_small_inputs(spark):
    def mk(n):
        rows = [rec(city="A", temperature=float(i), humidity=10 + i, pressure=900 + i, wind_speed=1.0 + i, clouds=i,
                    timestamp=f"2024-01-01T00:0{i}:00+00:00") for i in range(n)]
        return spark.createDataFrame(rows, RECORD_SCHEMA)
    assert anom.detect_anomalies(mk(0)).count() == 0
    assert anom.detect_anomalies(mk(4)).count() == 0
    assert anom.detect_anomalies(mk(5), **SMALL).count() == 1


def test_constant_and_null_features(spark):
    rows = [rec(city="A", temperature=float(i % 7), humidity=50, pressure=None, wind_speed=float(i % 5), clouds=i % 11,
                timestamp=f"2024-01-01T00:00:{i:02d}+00:00") for i in range(60)]
    df = spark.createDataFrame(rows, RECORD_SCHEMA)
    m = anom.fit_model(df, **SMALL)
    assert "pressure" not in m.features                      # all NULL: dropped
    hum = m.features.index("humidity")
    assert all(r[2] != hum for r in m.forest.extra["nodes"])  # constant: never split on


def test_model_store_roundtrip(spark, clean, model):
    root = work_dir(spark, "test-model")
    assert model_store.load_model(spark, root) is None
    model_store.save_model(spark, model, root, 3)
    model_store.save_model(spark, model, root, 3)   # replay of the same version
    loaded = model_store.load_model(spark, root)
    assert loaded.version == 3 and loaded.threshold == model.threshold
    assert model_store.load_nodes(spark, root, 3).count() == len(model.forest.extra["nodes"])
    assert _scores(clean, loaded) == _scores(clean, model)


def test_exact_quantile_narrowing_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=5000), np.full(300, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(5)
    for q in (0.05, 0.5, 0.999):
        got = exact_quantile(df, "v", q)
        assert got == pytest.approx(float(np.percentile(vals, 100 * q)), rel=0, abs=1e-12)


def test_summaries_on_empty_input(spark, clean, model):
    from obsflow.operators import scoring
    empty = anom.apply_model(clean.limit(0), model)
    s = anom.score_summary(empty).first()
    assert (s["n_flagged"], s["n_total"], s["flagged_share"], s["min_flagged_score"]) == (0, 0, 0.0, None)
    r = scoring.anomaly_rate(empty).first()
    assert (r["n_total"], r["n_anomalies"], r["anomaly_rate"], r["rate_text"]) == (0, 0, 0.0, "0.0%")


def test_histogram_non_finite_and_edges(spark):
    from obsflow.operators import scoring
    df = spark.createDataFrame([("A", 0.0), ("A", 10.0), ("B", 5.0), ("B", float("nan")), ("B", float("inf")),
                                ("C", None)], "city string, v double")
    got = {(r["city"], r["bin"]): r["n"] for r in scoring.histogram_by(df, "v", bins=20).collect()}
    assert got == {("A", 1): 1, ("A", 20): 1, ("B", 11): 1}
    same = spark.createDataFrame([("A", 2.0), ("A", 2.0)], "city string, v double")
    assert [tuple(r) for r in scoring.histogram_by(same, "v").collect()] == [("A", 1, 2.0, 2)]


def test_exact_quantile_with_infinities(spark):
    vals = [float(i) for i in range(200)] + [float("inf")] * 5 + [float("-inf")] * 3 + [float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for q in (0.0, 0.01, 0.5, 0.99, 1.0):
        assert exact_quantile(df, "v", q) == pytest.approx(float(spark.createDataFrame(
            [(v,) for v in vals if v == v], "v double").agg(F.percentile("v", F.lit(q))).first()[0]), nan_ok=True)


@pytest.mark.parametrize("vals", [
    [5.0] * 50_000 + [7.0], [1e308, -1e308, 0.0], [5e-324, 0.0, 5e-324], [0.001, 0.002, 0.003], [1e-300, 1.0, 1e300], [2.5], []])
def test_quantiles_collect_no_more_than_the_buckets(spark, vals, monkeypatch):
    from obsflow.functions import numeric
    sizes = []
    real = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: (lambda r: (sizes.append(len(r)), r)[1])(real(self)))
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for q in (0.05, 0.5):
        got = numeric.exact_quantile(df, "v", q)
        want = float(np.percentile(vals, 100 * q)) if vals else None
        assert got == (pytest.approx(want, rel=1e-12) if vals else None)
    assert max(sizes, default=0) <= numeric.BUCKETS * 2


def test_quantiles_by_group(spark):
    from obsflow.functions.numeric import quantiles_by
    rng = np.random.default_rng(5)
    rows = [(None if g == 3 else f"g{g}", float(v), float(rng.integers(3)) if g else None)
            for g in range(4) for v in np.concatenate([rng.normal(size=400) * 10.0 ** (3 * g), [1.5] * 300])]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    got = {r["g"]: (r["a"], r["b"]) for r in quantiles_by(df, ["g"], ["a", "b"], 0.5).collect()}
    want = {r["g"]: (r["a"], r["b"]) for r in df.groupBy("g").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(got[k], want[k]):
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12)


def test_copies_are_sampled_per_row(spark):
    """A third of all rows identical, no key: every tree gets psi rows, about a third of them copies."""
    from pyspark.sql import Window
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id").cast("double")).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise((F.col("id") * 7 % 1000).cast("double")).alias("b"))
    rows = iforest.keyed_rows(df, ["a", "b"], [], copies=1000)
    assert rows.count() == n and rows.select("__h").distinct().count() == n
    pairs = iforest.tree_samples(rows, ["a", "b"], n, 256, n_trees=50)
    per_tree = pairs.groupBy("tree_id").agg(F.count(F.lit(1)).alias("k")).collect()
    assert len(per_tree) == 50 and max(r["k"] for r in per_tree) < 3 * 256
    top = pairs.withColumn("rk", F.row_number().over(Window.partitionBy("tree_id").orderBy("__r", "__h"))) \
        .where(F.col("rk") <= 256)
    share = top.agg(F.avg(((F.col("a") == 1.0) & (F.col("b") == 2.0)).cast("double"))).first()[0]
    assert 0.28 < share < 0.39
    nodes, psi = iforest.fit_nodes(df, ["a", "b"], [], n_trees=50)
    roots = [r for r in nodes.collect() if r["node_id"] == 0]
    assert psi == 256 and len(roots) == 50 and all(r["n_rows"] == 256 for r in roots)


@pytest.mark.parametrize("keys", [["id"], []])
def test_forest_does_not_depend_on_the_layout(spark, keys):
    base = spark.range(5000).select("id", (F.col("id") * 37 % 1009).cast("double").alias("a"),
                                    (F.col("id") % 7).cast("double").alias("b"))
    forests = [sorted(map(tuple, iforest.fit_nodes(d, ["a", "b"], keys, n_trees=20)[0].collect()))
               for d in (base.coalesce(1), base.repartition(7), base.orderBy(F.rand(3)).repartition(3))]
    assert forests[0] == forests[1] == forests[2]


def test_any_sample_size_is_honoured(spark):
    df = spark.range(60_000).select("id", F.col("id").cast("double").alias("a"))
    nodes, psi = iforest.fit_nodes(df, ["a"], ["id"], n_trees=2, max_samples=45_000)
    assert psi == 45_000 and {r["n_rows"] for r in nodes.where("node_id = 0").collect()} == {45_000}


def test_infinite_values_are_missing_values(spark):
    from obsflow.operators import features as feat
    rows = [(float(i), float(i % 9)) for i in range(844)] + [(float("inf"), 1.0), (float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "temperature double, wind_speed double").withColumn("event_id", F.monotonically_increasing_id())
    assert feat.non_finite_counts(df, ["temperature", "wind_speed"]) == {"temperature": 2, "wind_speed": 0}
    m = anom.fit_model(df, n_trees=20)
    used = {r[2] for r in m.forest.extra["nodes"]}
    assert m.stats["temperature"]["median"] == 421.5 and {0, 1} <= used
    assert anom.apply_model(df, m).where("anomaly_score is null or isnan(anomaly_score)").count() == 0


def test_detection_scores_every_row_once(spark, clean, capsys):
    anom.detect_anomalies(clean, n_trees=10).explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out   # reads the scores written while fitting


def _chain(depth):
    """Tree 0: a chain that only its last node ends; tree 1: one leaf."""
    rows = []
    for d in range(depth):
        rows += [(0, 2 * d, 0, float(-d), 2 * d + 2, 2 * d + 1, d, depth - d + 1), (0, 2 * d + 1, -1, None, -1, -1, d + 1, 1)]
    rows.append((0, 2 * depth, -1, None, -1, -1, depth, 1))
    return [dict(zip(("tree_id", "node_id", "feature", "threshold", "left", "right", "depth", "n_rows"), r)) for r in
            rows + [(1, 0, -1, None, -1, -1, 0, 2)]]


def test_deep_tree_takes_memory_by_nodes():
    f = iforest.Forest.from_nodes(_chain(500), ["x"], 256)   # 2^500 slots as a complete tree
    assert f.n_nodes == 1002 and f.feature.size == f.threshold.size == f.child.size == f.leaf_h.size == 1002
    x = np.array([[1.0], [-0.5], [-3.5], [-600.0], [np.nan]])
    got = f.path_lengths(x) - 1.0                            # tree 1: one leaf of two rows
    assert got.tolist() == [1.0, 2.0, 5.0, 500.0, 1.0]       # NaN goes right


def test_forest_beyond_the_size_is_refused(monkeypatch):
    monkeypatch.setattr(iforest, "MAX_BYTES", 1000)
    with pytest.raises(ValueError, match="max_samples"):
        iforest.Forest.from_nodes(_chain(100), ["x"], 256)
