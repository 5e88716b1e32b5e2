from pyspark.sql import functions as F

from obsflow.plans import queries as Q
from obsflow.schemas import RECORD_SCHEMA
from obsflow.session import work_dir
from obsflow.sources import history
from obsflow.sources.tables import weather_view
from obsflow.operators import windows
from tests.conftest import SF001, rec


def _batch(spark, b, n):
    rows = [rec(city=f"c{i % 10}", temperature=float(i), timestamp=f"2024-01-0{b + 1}T00:{i // 60 % 60:02d}:{i % 60:02d}+00:00")
            for i in range(n)]
    return spark.createDataFrame(rows, RECORD_SCHEMA).withColumn("event_time", F.try_to_timestamp("timestamp"))


def test_replay_is_idempotent_and_last_n(spark):
    path = work_dir(spark, "test-hist")
    for b in range(3):
        history.write_batch(_batch(spark, b, 900), path, b)
    history.write_batch(_batch(spark, 2, 900), path, 2)      # replayed batch
    hist = history.read_history(spark, path)
    assert hist.count() == 2700
    last = history.history_last_n(hist, 2000)
    got = last.groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["count"]) for r in got] == [(0, 200), (1, 900), (2, 900)]


def test_missing_tables_are_empty(spark):
    assert history.records_scan(spark, "/nonexistent/obsflow").count() == 0
    assert history.agg_scan(spark, "/nonexistent/obsflow").columns[0] == "window_start"


def test_stream_equals_batch_on_closed_windows(spark):
    stream = Q.q_stream_window_sink(spark, SF001)
    wv = weather_view(spark, SF001)
    wm = wv.agg(F.max("event_time")).first()[0]
    import datetime as dt
    cutoff = (wm - dt.timedelta(minutes=10)).strftime("%Y-%m-%d %H:%M:%S.%f")
    batch = windows.window_aggregates(wv).where(F.col("window_end") <= F.lit(cutoff))
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def test_restart_equals_single_run(spark):
    a = Q.q_stream_window_sink(spark, SF001)
    b = Q.q_stream_restart(spark, SF001)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_late_data_dropped_from_third_batch(spark):
    full = Q.q_stream_window_sink(spark, SF001)
    late = Q.q_stream_late_data(spark, SF001)
    assert 0 < late.count() < full.count()


def test_record_sink_replay_keeps_counts(spark):
    from obsflow.streaming import jobs
    base = work_dir(spark, "test-sink")
    sink = jobs.RecordSink(base, detect=False)
    batch = _batch(spark, 0, 50).withColumn("offset", F.monotonically_increasing_id()) \
        .withColumn("humidity", F.lit(50)).withColumn("pressure", F.lit(1000)) \
        .withColumn("wind_speed", F.lit(1.0)).withColumn("visibility", F.lit(100))
    sink(batch, 7)
    sink(batch, 7)   # at-least-once replay of the same epoch
    from obsflow.operators.quality import clean_records
    assert history.read_history(spark, sink.records_path).count() == clean_records(batch).count()
    q = spark.read.parquet(sink.quality_path).collect()
    assert len(q) == 1 and q[0]["n_rows"] == 50


def test_capped_anomaly_rate(spark):
    from obsflow.operators.anomalies import capped_anomaly_rate
    rec_path, an_path = work_dir(spark, "test-cap-rec"), work_dir(spark, "test-cap-an")
    for b in range(3):
        history.write_batch(_batch(spark, b, 900), rec_path, b)
        history.write_batch(_batch(spark, b, 200), an_path, b)
    rec, an = history.read_history(spark, rec_path), history.read_history(spark, an_path)
    capped = capped_anomaly_rate(rec, an, cap_records=2000, cap_anomalies=500).first()
    assert (capped["n_total"], capped["n_anomalies"], capped["anomaly_rate"], capped["rate_text"]) == \
        (2000, 500, 25.0, "25.0%")
    whole = capped_anomaly_rate(rec, an).first()
    assert (whole["n_total"], whole["n_anomalies"]) == (2700, 600)


def test_last_n_reads_only_newest_batches(spark):
    from obsflow.plans.explain import plan_text
    path = work_dir(spark, "test-prune")
    for b in range(3):
        history.write_batch(_batch(spark, b, 900), path, b)
    last = history.history_last_n(history.read_history(spark, path), 900)
    assert "PartitionFilters: [isnotnull(batch_id" in plan_text(last) and "(batch_id#" in plan_text(last)
    assert {r["batch_id"] for r in last.select("batch_id").distinct().collect()} == {2}
    assert last.count() == 900


def test_agg_scan_parquet(spark):
    path = work_dir(spark, "test-agg-parquet")
    wins = windows.window_aggregates(weather_view(spark, SF001))
    wins.write.parquet(path)
    assert history.agg_scan(spark, path, fmt="parquet").count() == wins.count()


def test_late_data_equals_brute_force(spark):
    """The late-data stream equals a plain simulation of the watermark rules (small fixture):
    a batch's rows are late when their window ended at or before the watermark left by the
    earlier batches (max event time - 10 min); closed windows of kept rows are written."""
    import datetime as dt
    got = {(r["window_start"], r["city"]): r["record_count"] for r in Q.q_stream_late_data(spark, SF001).collect()}
    wv = weather_view(spark, SF001).select("city", F.unix_micros("event_time").alias("t")).collect()
    a, b = min(r["t"] for r in wv), max(r["t"] for r in wv)
    step, W, D = (b - a) // 5 + 1, 5 * 60 * 10**6, 10 * 60 * 10**6
    wm, seen, kept = None, None, []
    for c in [2, 0, 4, 1, 3]:
        rows = [r for r in wv if (r["t"] - a) // step == c]
        kept += [(r["t"] - r["t"] % W, r["city"]) for r in rows
                 if wm is None or r["t"] - r["t"] % W + W > wm]
        seen = max([seen or -1] + [r["t"] for r in rows])
        wm = max(wm or 0, seen - D)
    want = {}
    for ws, city in kept:
        if ws + W <= wm:
            k = (dt.datetime.fromtimestamp(ws / 1e6, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), city)
            want[k] = want.get(k, 0) + 1
    assert got == want


def test_score_then_retrain_policy(spark):
    """Each batch is scored with the newest model committed before it; retrains every 2 batches."""
    from obsflow.operators import anomalies as anom
    from obsflow.sources import model_store
    sink = Q._stream_records(spark, SF001, "test-policy", detect=True, n_chunks=5,
                             mode="score_then_retrain", retrain_every=2, fit_args={"n_trees": 10})
    assert model_store.committed_versions(spark, sink.model_path) == [0, 2, 4]
    rec = history.read_history(spark, sink.records_path)
    an = history.read_history(spark, sink.anomalies_path)
    used = {0: 0, 1: 0, 2: 0, 3: 2, 4: 2}           # retraining happens after a batch is scored
    for b, v in used.items():
        model = model_store.load_model(spark, sink.model_path, v)
        batch = rec.where(F.col("batch_id") == b).drop("batch_id", "row_hash")
        want = {(r["offset"], r["anomaly_score"]) for r in
                anom.apply_model(batch, model).where("is_anomaly").select("offset", "anomaly_score").collect()}
        got = {(r["offset"], r["anomaly_score"]) for r in
               an.where(F.col("batch_id") == b).select("offset", "anomaly_score").collect()}
        assert got == want, b
    # an at-least-once replay of the last batch (which also retrained) gives the same anomalies
    before = {tuple(r) for r in an.where("batch_id = 4").select("offset", "anomaly_score").collect()}
    replay = rec.where("batch_id = 4").drop("batch_id", "row_hash").persist()
    replay.count()
    sink(replay, 4)
    after = {tuple(r) for r in history.read_history(spark, sink.anomalies_path)
             .where("batch_id = 4").select("offset", "anomaly_score").collect()}
    assert after == before and model_store.committed_versions(spark, sink.model_path) == [0, 2, 4]


def test_input_quality_of_each_batch(spark):
    """Late rows by the newest time of the batches before; a replay and a restarted sink give the same row."""
    from datetime import datetime, timedelta
    from pyspark.sql.types import StructField, StructType, TimestampType

    from obsflow.streaming import jobs
    t0 = datetime(2024, 1, 1, 12, 0)
    schema = StructType([*RECORD_SCHEMA.fields, StructField("event_time", TimestampType())])
    minutes = [[0, 1, None], [30, 31], [19, 20, 21, 24, 26, None], [40]]

    def batch(i):
        rows = [rec(city="A", temperature=1.0, event_time=None if m is None else t0 + timedelta(minutes=m)) for m in minutes[i]]
        return spark.createDataFrame(rows, schema)
    base = work_dir(spark, "input-quality")
    sink = jobs.RecordSink(base, detect=False)
    for i in (0, 1, 2):
        sink(batch(i), i)
    sink(batch(2), 2)                                   # a replay
    again = jobs.RecordSink(base, detect=False)         # a restart, which replays the last batch
    again(batch(2), 2)
    again(batch(3), 3)
    rows = history.read_history(spark, base + "/input").orderBy("batch_id").collect()
    # newest time before batch 2: 12:31, so the watermark is 12:21; windows that end at 12:20 are closed
    assert [(r["rows_in"], r["null_time"], r["late_rows"]) for r in rows] == [(3, 1, 0), (2, 0, 0), (6, 1, 1), (1, 0, 0)]
    assert [r["seen_until"] for r in rows] == [t0 + timedelta(minutes=m) for m in (1, 31, 31, 40)]
