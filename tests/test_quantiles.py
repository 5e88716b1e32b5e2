"""Exact quantiles in two passes: wide brackets, lost ranks, counted values, few jobs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.functions import numeric

RNG = random.Random(8)
ROWS = [(RNG.choice("abcc"), RNG.choice([None, RNG.gauss(0, 1), RNG.randint(0, 3) * 1.0, 1e300, -1e-300, float("inf")]),
         RNG.random()) for _ in range(3000)] + [("one", 5.0, None), (None, 2.0, 1.0), ("none", None, None)]


def want(values, q):
    got = [v for v in values if v is not None]
    return float(np.quantile(np.array(got), q)) if got else None


def frame(spark):
    return spark.createDataFrame(ROWS, "g string, v double, u double").repartition(5)


def close(a, b):
    return (a is None and b is None) or a == pytest.approx(b, rel=1e-12, nan_ok=True)


@pytest.mark.parametrize("settings", [{}, {"COLLECTED": 0, "ORDERED": 0}, {"SLACK": 0.0},
                                      {"SLACK": 0.0, "COLLECTED": -1, "ORDERED": -1, "SKETCH_K": 8}])
@pytest.mark.parametrize("q", [0.05, 0.5])
def test_quantiles_whatever_the_brackets(spark, monkeypatch, settings, q):
    """Tables instead of collected brackets, and brackets too narrow or from a coarse sketch, change nothing."""
    for k, v in settings.items():
        monkeypatch.setattr(numeric, k, v)
    df = frame(spark)
    got = numeric.exact_quantiles(df, ["v", "u"], q)
    assert close(got["v"], want([r[1] for r in ROWS], q)) and close(got["u"], want([r[2] for r in ROWS], q))
    by = {r["g"]: (r["v"], r["u"]) for r in numeric.quantiles_by(df, ["g"], ["v", "u"], q).collect()}
    for g in ["a", "b", "c", "one", None]:
        for c in (0, 1):
            assert close(by[g][c], want([r[1 + c] for r in ROWS if r[0] == g], q)), (g, c)


def test_counted_values_equal_the_rows_they_stand_for(spark):
    counted = frame(spark).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    for q in (0.0, 0.05, 0.5):
        assert close(numeric.exact_quantiles(counted, ["v"], q, weight="n")["v"], want([r[1] for r in ROWS], q))


def test_two_passes_over_the_data(spark):
    """The rows are evaluated twice, however many digits the values have."""
    seen = spark.sparkContext.accumulator(0)
    data = spark.range(0, 20_000, 1, 4).select((F.hash("id") / F.lit(7.0)).alias("v"))

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    counted = data.mapInArrow(count, "v double")
    values = [r["v"] for r in data.collect()]
    assert close(numeric.exact_quantile(counted, "v", 0.37), want(values, 0.37))
    assert seen.value == 2 * 20_000


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, None)], "g string, v double")
    assert numeric.exact_quantiles(df, ["v"], 0.5) == {"v": None}
    assert numeric.exact_quantiles(df.where("false"), ["v"], 0.5) == {"v": None}
    assert numeric.quantiles_by(df.where("false"), ["g"], ["v"], 0.5).collect() == []
