from pyspark.sql import functions as F

from obsflow.functions import lookups
from obsflow.functions.text import capitalize_first, fixed_1dp
from obsflow.operators import serve
from obsflow.plans.explain import plan_text
from obsflow.schemas import RECORD_SCHEMA
from tests.conftest import rec


def _df(spark, rows):
    return spark.createDataFrame([rec(**r) for r in rows], RECORD_SCHEMA) \
        .withColumn("event_time", F.try_to_timestamp("timestamp"))


def test_latest_non_null_value(spark):
    df = _df(spark, [
        dict(city="Paris", temperature=10.0, humidity=40, timestamp="2024-01-01T10:00:00+00:00"),
        dict(city="Paris", temperature=None, humidity=41, timestamp="2024-01-01T11:00:00+00:00"),
        dict(city="Paris", temperature=99.0, humidity=99, timestamp=None),      # no time: ignored
        dict(city=None, temperature=1.0, timestamp="2024-01-01T12:00:00+00:00"),  # no city: absent
    ])
    out = serve.latest_by_city(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r["city"] == "Paris" and r["temperature"] == 10.0 and r["humidity"] == 41
    row_mode = serve.latest_by_city(df, mode="row").first()
    assert row_mode["temperature"] is None


def test_text_helpers(spark):
    df = spark.createDataFrame([("broken CLOUDS", 0.25, -0.04), ("x", 12.35, 0.05)], "s string, a double, b double")
    out = df.select(capitalize_first("s").alias("c"), fixed_1dp("a").alias("fa"), fixed_1dp("b").alias("fb")).collect()
    assert [r["c"] for r in out] == ["Broken clouds", "X"]
    assert [r["fa"] for r in out] == ["0.3", "12.4"]
    assert [r["fb"] for r in out] == ["0.0", "0.1"]


def test_lookup_default(spark):
    df = spark.createDataFrame([("Paris",), ("Atlantis",), (None,)], "city string")
    dim = lookups.dimension(spark, lookups.CITY_FLAGS, "city", "flag")
    out = {r["city"]: r["flag"] for r in lookups.lookup_with_default(df, dim, "city", "flag",
                                                                    lookups.DEFAULT_FLAG).collect()}
    assert out["Paris"] == lookups.CITY_FLAGS["Paris"] and out["Atlantis"] == lookups.DEFAULT_FLAG
    assert out[None] == lookups.DEFAULT_FLAG
    plan = plan_text(lookups.lookup_with_default(df, dim, "city", "flag", "?"))
    assert "Broadcast" in plan


def test_top_k_per_group_uses_partial_limit(spark):
    df = spark.range(0, 10000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = serve.top_k_per_group(df, ["g"], [F.desc("v")], 5)
    assert out.count() == 15
    assert sorted(r["v"] for r in out.where("g = 0").collect()) == [9984, 9987, 9990, 9993, 9996, 9999][1:]
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan


def test_city_matrix_widens(spark):
    df = _df(spark, [dict(city="A", temperature=1.5, humidity=40, pressure=1000, wind_speed=2.0, clouds=3,
                          timestamp="2024-01-01T10:00:00+00:00")])
    m = {r["metric"]: r["value"] for r in serve.city_metric_matrix(serve.latest_by_city(df)).collect()}
    assert m == {"temperature": 1.5, "humidity": 40.0, "pressure": 1000.0, "wind_speed": 2.0, "clouds": 3.0}
    wide = serve.city_metric_wide(serve.latest_by_city(df), ["A", "B"]).collect()
    assert {r["metric"]: r["A"] for r in wide}["pressure"] == 1000.0


def test_size_for_input(spark):
    from obsflow.session import size_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_input(spark, 100 << 40, 8000) == (100 << 40) // (256 << 20)
        assert size_for_input(spark, 10 << 20, 8) == 16
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty_input_everywhere(spark):
    from obsflow.operators import anomalies, features, quality, scoring, windows
    from obsflow.sources import messages
    empty = spark.createDataFrame([], RECORD_SCHEMA).withColumn("event_time", F.try_to_timestamp("timestamp"))
    assert quality.clean_records(empty).count() == 0
    rep = quality.quality_report(empty).first()
    assert rep["n_rows"] == 0 and rep["n_kept"] == 0 and rep["n_bad_temperature"] == 0
    assert windows.window_aggregates(empty).count() == 0
    assert windows.poll_completeness(empty).count() == 0
    lat = serve.latest_by_city(empty)
    assert lat.count() == 0 and serve.current_conditions(lat).count() == 0
    assert serve.dual_series(empty).count() == 0 and serve.agg_table_tail(windows.window_aggregates(empty)).count() == 0
    st = {r["feature"]: r for r in features.feature_stats(empty).collect()}
    assert st["temperature"]["n"] == 0 and st["temperature"]["median"] is None
    assert features.feature_deviation(empty).count() == 5
    assert scoring.histogram_by(empty, "temperature").count() == 0
    assert scoring.percentile_flag(empty, "temperature").count() == 0
    assert anomalies.detect_anomalies(empty).count() == 0
    assert messages.parse_messages(messages.encode_messages(empty)).count() == 0


def test_clock_text_and_single_shuffle(spark):
    from obsflow.functions.text import clock_text
    from obsflow.operators import windows
    from obsflow.plans.explain import count_exchanges
    from obsflow.sources.tables import weather_view
    from tests.conftest import SF001
    t = spark.range(1).select(clock_text(F.lit("2024-01-01 10:04:59").cast("timestamp")).alias("t")).first()["t"]
    assert t == "10:04:59 UTC"
    wins = windows.window_aggregates(weather_view(spark, SF001))
    assert count_exchanges(wins) == 1
    assert "partial_avg" in plan_text(wins, "simple")      # combined per partition before the shuffle


def test_latest_row_mode_ties_are_deterministic(spark):
    rows = [dict(city="A", temperature=float(i), humidity=i, timestamp="2024-01-01T10:00:00+00:00") for i in range(6)]
    df = _df(spark, rows)
    a = serve.latest_by_city(df, mode="row").first()
    b = serve.latest_by_city(df.repartition(3), mode="row").first()
    assert a == b and a["humidity"] == int(a["temperature"])   # one whole row, same either way


def test_refresh_clock_column(spark):
    import re

    from obsflow.operators import serve
    from obsflow.sources.tables import weather_view
    from tests.conftest import SF001
    cards = serve.current_conditions(serve.latest_by_city(weather_view(spark, SF001)), clock=True)
    assert cards.columns[-1] == "refreshed_at" and re.fullmatch(r"\d\d:\d\d:\d\d UTC", cards.first()["refreshed_at"])


def test_latest_reads_few_ranges_of_time(spark):
    """A city that fell silent a year ago adds its own days to the second pass, not all days since."""
    from datetime import datetime, timedelta

    from obsflow.plans.explain import plan_text
    from obsflow.session import work_dir
    t0 = datetime(2024, 1, 1)
    rows = [("old", t0, 1.0, None), ("old", t0 - timedelta(days=2), 0.0, 5)] + [
        ("new", t0 + timedelta(hours=h), float(h), h) for h in range(24 * 365)]
    path = work_dir(spark, "latest-in")
    spark.createDataFrame(rows, "city string, event_time timestamp, temperature double, humidity int").write.parquet(path)
    df = spark.read.parquet(path)
    out = serve.latest_by_city(df)
    got = {r["city"]: (r["temperature"], r["humidity"], r["event_time"]) for r in out.collect()}
    last = t0 + timedelta(hours=24 * 365 - 1)
    assert got == {"old": (1.0, 5, t0), "new": (float(24 * 365 - 1), 24 * 365 - 1, last)}
    pushed = [line for line in plan_text(out).splitlines() if "PushedFilters" in line and "event_time" in line]
    assert any("Or(" in line and "GreaterThanOrEqual(event_time" in line for line in pushed)
    newest = df.groupBy("city").agg(F.max("event_time").alias("t"))
    assert serve.time_ranges(newest, ["t"]) == [(t0, t0), (last, last)]
    assert serve.time_ranges(newest, ["t"], most=1) == [(t0, last)]
    many = df.where("city = 'new'")
    ranges = serve.time_ranges(many.withColumnRenamed("event_time", "t"), ["t"], most=5)
    assert len(ranges) == 5 and all(any(a <= r[1] <= b for a, b in ranges) for r in rows[2:])
