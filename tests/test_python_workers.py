"""One Python evaluation of a score, whatever reads it."""

from pyspark.sql import functions as F

from obsflow.operators import anomalies as anom
from obsflow.operators import forest as iforest
from obsflow.operators import scoring
from obsflow.operators.features import FEATURES
from obsflow.plans import queries as Q
from obsflow.plans.explain import plan_text


def _observations(spark):
    return spark.range(500).select("id", F.lit("x").alias("city"), *[(F.col("id") * (37 + i) % 1200).cast("double").alias(f)
                                                                     for i, f in enumerate(FEATURES)])


def test_flagged_rows_are_scored_once(spark):
    rows, model = _observations(spark), Q._fixed_model(spark)
    scores = sorted(r[0] for r in iforest.score(rows, model.forest, FEATURES).select("anomaly_score_raw").collect())
    scored = anom.apply_model(rows, model, threshold=(scores[0] + scores[-1]) / 2)
    assert plan_text(scored.where("is_anomaly"), "simple").count("ArrowEvalPython") == 1
    assert plan_text(scored.drop("anomaly_label", "anomaly_score", "is_anomaly"), "simple").count("ArrowEvalPython") == 0
    want = sorted((r["id"], r["anomaly_score"]) for r in scored.collect() if r["is_anomaly"])
    assert 0 < len(want) < 500
    assert sorted((r["id"], r["anomaly_score"]) for r in scored.where("is_anomaly").collect()) == want
    assert scoring.histogram_by(scored.where("is_anomaly"), "anomaly_score", "city").agg(F.sum("n")).first()[0] == len(want)


def test_score_without_a_value_is_null(spark):
    leaf = iforest.Forest.from_nodes(iforest.literal_nodes(spark, [[(0, 0, -1, None, -1, -1, 0, 1)]]).collect(), ["a"], 1)
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert [r["anomaly_score_raw"] for r in iforest.score(df, leaf).collect()] == [None, None]
