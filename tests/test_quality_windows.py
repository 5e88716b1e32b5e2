import math

import pytest

from pyspark.sql import functions as F

from obsflow.operators import quality, windows
from obsflow.plans.explain import plan_text
from obsflow.schemas import RECORD_SCHEMA
from obsflow.sources.tables import weather_view
from tests.conftest import SF01, rec


def _bounds_df(spark):
    ok = dict(temperature=0.0, humidity=50, pressure=1000, wind_speed=1.0, visibility=100)
    cases = []
    for f, vals_in, vals_out in [("temperature", [-60.0, 60.0], [-60.01, 60.01, None, float("nan")]),
                                 ("humidity", [0, 100], [-1, 101, None]),
                                 ("pressure", [870, 1085], [869, 1086, None]),
                                 # NaN sorts above every number: it passes ">= 0"
                                 ("wind_speed", [0.0, float("nan")], [-0.01, None]),
                                 ("visibility", [0], [-1, None])]:
        cases += [(dict(ok, **{f: v}), True) for v in vals_in]
        cases += [(dict(ok, **{f: v}), False) for v in vals_out]
    rows = [rec(city=str(i), **c) for i, (c, _) in enumerate(cases)]
    return spark.createDataFrame(rows, RECORD_SCHEMA), {str(i): k for i, (_, k) in enumerate(cases)}


def test_bounds_inclusive_null_nan(spark):
    df, expect = _bounds_df(spark)
    kept = {r["city"] for r in quality.clean_records(df).collect()}
    assert kept == {c for c, k in expect.items() if k}


def test_clean_union_rejected_is_input(spark):
    df, _ = _bounds_df(spark)
    assert quality.clean_records(df).count() + quality.rejected_records(df).count() == df.count()


def test_quality_report_counts_sf001(spark):
    r = quality.quality_report(weather_view(spark, SF01)).first()
    assert (r["n_rows"], r["n_kept"]) == (10000, 8337)
    assert (r["n_bad_temperature"], r["n_bad_humidity"], r["n_bad_pressure"],
            r["n_bad_wind_speed"], r["n_bad_visibility"]) == (233, 285, 1000, 125, 123)


def _timed(spark, rows):
    df = spark.createDataFrame([rec(city=c, temperature=t, humidity=50, pressure=1000, wind_speed=1.0,
                                    clouds=10, timestamp=ts) for c, t, ts in rows], RECORD_SCHEMA)
    return df.withColumn("event_time", F.try_to_timestamp("timestamp"))


def test_window_edges_and_null_time(spark):
    df = _timed(spark, [("A", 1.0, "2024-01-01T10:04:59.999+00:00"), ("A", 3.0, "2024-01-01T10:05:00+00:00"),
                        ("A", 5.0, None)])
    out = {r["window_start"]: r for r in windows.window_aggregates(df).collect()}
    assert set(out) == {"2024-01-01 10:00:00", "2024-01-01 10:05:00"}
    assert all(r["record_count"] == 1 and r["stddev_temp"] is None for r in out.values())


def test_window_properties(spark):
    wv = weather_view(spark, SF01)
    w = windows.window_aggregates(wv)
    tot = w.agg(F.sum("record_count")).first()[0]
    assert tot == wv.where(F.col("event_time").isNotNull()).count()
    assert w.where((F.col("min_temp") > F.col("avg_temp") + 0.005)
                   | (F.col("avg_temp") > F.col("max_temp") + 0.005)).count() == 0


def test_half_up_rounding(spark):
    df = _timed(spark, [("A", 12.34, "2024-01-01T10:00:00+00:00"), ("A", 12.35, "2024-01-01T10:01:00+00:00"),
                        ("B", -0.01, "2024-01-01T10:00:00+00:00"), ("B", -0.02, "2024-01-01T10:01:00+00:00")])
    out = {r["city"]: r["avg_temp"] for r in windows.window_aggregates(df).collect()}
    assert out["A"] == 12.35 and out["B"] == -0.02  # ties go away from zero
    assert not math.isnan(out["A"])


def test_plan_pushes_filters_and_prunes(spark, tmp_path):
    path = str(tmp_path / "records")
    weather_view(spark, SF01).write.parquet(path)
    q = quality.clean_records(spark.read.parquet(path)).select("city", "temperature")
    plan = plan_text(q)
    assert "PushedFilters: [IsNotNull(temperature)" in plan
    assert "GreaterThanOrEqual(temperature,-60.0)" in plan
    # only the 2 projected + 5 filtered columns are read
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in read.split(",")) == sorted(
        ["city", "temperature", "humidity", "pressure", "wind_speed", "visibility"])


def test_non_finite_values_follow_double_semantics(spark):
    rows = [("A", 1.0), ("A", float("nan")), ("B", float("inf")), ("B", 2.0), ("C", 1e300), ("C", 1.0),
            ("D", 1.25), ("D", 1.26)]
    df = _timed(spark, [(c, t, "2024-01-01T10:00:00+00:00") for c, t in rows])
    out = {r["city"]: r for r in windows.window_aggregates(df).collect()}
    assert math.isnan(out["A"]["avg_temp"]) and math.isnan(out["A"]["max_temp"])
    assert out["B"]["avg_temp"] == float("inf") and out["B"]["min_temp"] == 2.0
    assert out["C"]["max_temp"] == 1e300
    assert out["D"]["avg_temp"] == 1.26 and out["D"]["max_temp"] == 1.26   # exact path, half away from zero


def test_means_against_decimal_arithmetic(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from obsflow.functions.numeric import rounded_avg
    groups = {
        "ties": [1.25, 1.26], "neg_ties": [-1.25, -1.26], "thirds": [1.0, 1.0, 1.01],
        "mixed": [-3.5, 2.25, 0.01, 7.77, -0.02], "fine": [20.004, 20.004, 20.008], "one": [42.42],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    for digits in (1, 2, 6):
        got = {r["g"]: r["m"] for r in df.groupBy("g").agg(rounded_avg("v", digits).alias("m")).collect()}
        for g, vs in groups.items():
            exact = sum(Decimal(repr(v)) for v in vs) / Decimal(len(vs))
            want = float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))
            assert got[g] == want, (g, digits, got[g], want)


def test_windows_keep_every_digit_and_any_magnitude(spark):
    """Finer than 0.01, huge single values, and sums beyond any 64-bit count of hundredths."""
    rows = [("A", 20.004), ("A", 20.004), ("A", 20.008), ("B", 1e12), ("B", 10.0)] + [("C", 9e13)] * 1100
    out = {r["city"]: r for r in windows.window_aggregates(
        _timed(spark, [(c, t, "2024-01-01T10:00:00+00:00") for c, t in rows])).collect()}
    assert out["A"]["avg_temp"] == 20.01 and out["A"]["max_temp"] == 20.01 and out["A"]["min_temp"] == 20.0
    assert out["B"]["stddev_temp"] == pytest.approx(707106781179.48, rel=1e-12)
    assert out["C"]["avg_temp"] == 9e13 and out["C"]["stddev_temp"] == 0.0
