"""Incremental training: merged states equal full ones; failures of the model leave the batch; manifests."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsflow.operators import anomalies as anom
from obsflow.operators import features as feat
from obsflow.operators import training
from obsflow.operators.quality import clean_records
from obsflow.session import work_dir
from obsflow.sources import history, messages, model_store, state_store
from obsflow.sources.tables import weather_view
from obsflow.streaming import jobs
from tests.conftest import SF001, SF01

ARGS = {"n_trees": 8, "max_samples": 64}


def clean(spark, sf=SF01):
    return clean_records(weather_view(spark, sf))


def same(a, b):
    assert a.forest.extra["nodes"] == b.forest.extra["nodes"]
    assert a.stats == b.stats and a.n_train == b.n_train and a.threshold == b.threshold


def test_merged_batches_equal_one_fit(spark):
    df = clean(spark).withColumn("b", (F.xxhash64("event_id") % 9 + 9).cast("int")).persist()
    root = work_dir(spark, "test-state")
    for b in range(18):   # batches of unlike sizes, some empty
        state, upto = state_store.load_state(spark, root, before=b)
        assert upto == (b - 1 if b else None)
        rows = df.where(F.col("b") == b).drop("b")
        state = training.merged(state, rows, calibration=700, **ARGS)
        state_store.save_state(spark, state, root, b)
    got = training.fit_state(state_store.load_state(spark, root, before=18)[0], **ARGS)
    whole = training.merged(None, df.drop("b").repartition(13), calibration=700, **ARGS)
    same(got, training.fit_state(whole, **ARGS))
    stats = feat.stats_dict(feat.feature_stats(df))
    for f, s in got.stats.items():
        assert (s["n"], s["median"]) == (stats[f]["n"], stats[f]["median"])
        assert s["mean"] == pytest.approx(stats[f]["mean"], abs=2e-6) and s["std_pop"] == pytest.approx(stats[f]["std_pop"], abs=2e-6)
    # a replayed batch starts from the same state and writes the same one
    state, upto = state_store.load_state(spark, root, before=17)
    assert upto == 16
    again = training.merged(state, df.where("b = 17").drop("b"), calibration=700, **ARGS)
    state_store.save_state(spark, again, root, 17)
    same(training.fit_state(state_store.load_state(spark, root, before=18)[0], **ARGS), got)
    df.unpersist()


def test_samples_are_the_smallest_draws_of_all_rows(spark):
    df = clean(spark, SF001)
    state = training.merged(None, df, calibration=100, **ARGS)
    h = [r["h"] for r in df.select(F.xxhash64("event_id").alias("h")).collect()]
    first = {r["h"]: r["d"] for r in df.select(F.xxhash64("event_id").alias("h"))
             .select("h", training._first_draw(8, 0, 42).alias("d")).collect()}
    tree, draw = training.draws(np.array(h), np.array([first[x] for x in h]), 8, 42)
    assert (np.sort(tree, axis=1) == np.arange(8)).all() and (np.diff(draw, axis=1) > 0).all()
    got = {}
    for r in state.samples.where("tree_id >= 0").collect():
        got.setdefault(r["tree_id"], set()).add(r["h"])
    for t in range(8):
        mine = draw[np.arange(len(h)), (tree == t).argmax(axis=1)]
        assert got[t] == {h[i] for i in np.argsort(mine)[:64]}
    rng = draw.ravel()  # unit exponentials
    assert abs(rng.mean() - 1) < 0.1 and abs((rng < math.log(2)).mean() - 0.5) < 0.05
    assert state.samples.where("tree_id < 0").count() == 100
    state.samples.unpersist()


def test_rows_without_a_key_missing_values_and_few_rows(spark):
    rows = [(None, 1.0, float("nan"))] * 5 + [(2.0, 1.0, 4.0)] * 3 + [(float("inf"), 1.0, 7.5)]
    df = spark.createDataFrame(rows, "temperature double, humidity double, pressure double")
    state = training.merged(None, df, salt=0, n_trees=3, max_samples=4)
    assert state.n_rows == 9 and state.samples.where("tree_id < 0").count() == 9
    m = training.fit_state(state, n_trees=3, max_samples=4)
    assert m.features == ["temperature", "humidity", "pressure"] and m.stats["temperature"]["n"] == 3
    assert m.stats["temperature"]["median"] == 2.0 and m.stats["humidity"]["std_pop"] == 0.0
    more = training.merged(state, df, salt=1, n_trees=3, max_samples=4)
    assert more.n_rows == 18 and more.samples.where("tree_id < 0").count() == 18   # equal rows of two batches are two
    assert training.fit_state(training.merged(None, df.limit(4), n_trees=3), n_trees=3) is None
    empty = training.merged(None, df.where("false"), n_trees=3)
    assert empty.n_rows == 0 and training.fit_state(empty) is None


def batch(spark, sf=SF001):
    return messages.parse_messages(messages.encode_messages(weather_view(spark, sf), offset_col="event_id"),
                                   keep=["offset"], with_corrupt=True)


def test_a_retrain_reads_the_state_and_its_batch_only(spark):
    base = work_dir(spark, "test-retrain")
    sink = jobs.RecordSink(base, retrain_every=2, fit_args=ARGS)
    for b in range(5):
        sink(batch(spark).where(F.col("offset") % 5 == b), b)
    assert model_store.committed_versions(spark, sink.model_path) == [0, 2, 4]
    hist = history.read_history(spark, sink.records_path)
    want = training.fit_state(training.merged(None, hist.drop("batch_id", "row_hash"), **ARGS), version=4, **ARGS)
    got = model_store.load_model(spark, sink.model_path, 4)
    assert sorted(got.forest.extra["nodes"]) == want.forest.extra["nodes"] and got.threshold == want.threshold
    assert got.n_train == hist.count()
    # batches before the state are neither listed nor read: it works with their files out of sight
    seen = []
    real = history.read_batches

    def spy(spark, path, ids, anomalies=False):
        seen.append(list(ids))
        return real(spark, path, ids, anomalies)
    history.read_batches = spy
    try:
        sink(batch(spark, SF01).where("offset < 900"), 6)
        assert seen == [[6]]
        sink(batch(spark, SF01).where("offset < 900"), 6)   # replay: the same version again
    finally:
        history.read_batches = real
    a = model_store.load_model(spark, sink.model_path, 6)
    assert a.n_train == got.n_train + history.read_history(spark, sink.records_path).where("batch_id = 6").count()


def observed(spark, first, last):
    """Observations numbered ``first`` to ``last`` - 1, every 40th without clouds, spread by a hash of the number."""
    u = lambda k, lo, hi: F.lit(lo) + F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_007)) / 10_007.0 * (hi - lo)
    return spark.range(first, last, 1, 3).select(
        F.lit("Oslo").alias("city"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("event_time"),
        u(1, -20.0, 40.0).alias("temperature"), u(2, 0.0, 100.0).alias("humidity"), u(3, 900.0, 1060.0).alias("pressure"),
        u(4, 0.0, 30.0).alias("wind_speed"), F.when(F.col("id") % 40 != 0, u(5, 0.0, 100.0)).alias("clouds"),
        F.lit(10_000).alias("visibility"), F.col("id").alias("offset"))


def scores_of_all(df, model):
    """The scores of all rows, by a walk of the model's trees on the driver."""
    z = feat.standardize(df, model.stats, prefix="__z_", features=model.features)
    return model.forest.score(z.select(*[f"__z_{f}" for f in model.features]).toPandas().to_numpy(dtype=float))


def test_the_threshold_comes_from_the_scores_of_all_rows(spark):
    df = observed(spark, 0, 13_000)
    state = training.merged(None, df, **ARGS)
    assert state.samples.where("tree_id < 0").count() == 13_000
    m = training.fit_state(state, **ARGS)
    scores = scores_of_all(df, m)
    assert m.threshold == pytest.approx(np.quantile(scores, 0.05), rel=1e-12)
    state.samples.unpersist()


def test_a_retrained_threshold_comes_from_the_whole_history(spark):
    sink = jobs.RecordSink(work_dir(spark, "test-whole"), retrain_every=2, fit_args=ARGS)
    for b, (first, last) in enumerate([(0, 7_000), (7_000, 8_000), (8_000, 14_000)]):
        sink(observed(spark, first, last), b)
    m = model_store.load_model(spark, sink.model_path, 2)
    scores = scores_of_all(history.read_history(spark, sink.records_path), m)
    assert m.n_train == len(scores) == 14_000
    assert m.threshold == pytest.approx(np.quantile(scores, 0.05), rel=1e-12)


def part_names(spark, root):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/rows")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(folder)}


def test_stored_states_hold_each_row_once(spark, monkeypatch):
    monkeypatch.setattr(state_store, "PART_ROWS", 400)
    root = work_dir(spark, "test-parts")
    sizes = [100, 100, 0, 50, 500, 30, 30, 10, 70]
    ends = np.cumsum(sizes).tolist()

    def save(b, state):
        state = training.merged(state, observed(spark, ends[b] - sizes[b], ends[b]), **ARGS)
        return state_store.save_state(spark, state, root, b)

    def temperatures(state):
        return sorted(r["temperature"] for r in state.rows.collect())
    want = [sorted(r["temperature"] for r in observed(spark, 0, n).collect()) for n in ends]
    parts = []
    for b in range(len(sizes)):
        state = save(b, state_store.load_state(spark, root, before=b)[0])
        parts.append(list(state.parts.values()))
        assert temperatures(state) == want[b]
    assert parts == [[100], [200], [200], [200, 50], [750], [750, 30], [750, 60], [750, 60, 10], [750, 140]]
    before, upto = state_store.load_state(spark, root, before=8)     # the state before is whole, too; nothing else is left
    assert upto == 7 and temperatures(before) == want[7]
    assert part_names(spark, root) == set(before.parts) | set(state.parts)
    assert temperatures(save(8, before)) == want[8]                  # a replay
    left = observed(spark, 0, 7).select(*feat.FEATURES)
    left.write.parquet(f"{root}/rows/left")                          # a run that stopped half way leaves a part unnamed
    whole = training.merged(None, observed(spark, 0, ends[6]), **ARGS)
    assert temperatures(state_store.save_state(spark, whole, root, 6)) == want[6]    # built again from the history
    assert "left" not in part_names(spark, root)


def test_a_state_stored_without_its_rows_is_built_again(spark):
    sink = jobs.RecordSink(work_dir(spark, "test-old"), retrain_every=100, fit_args=ARGS)
    sink(observed(spark, 0, 600), 0)
    sink(observed(spark, 600, 900), 1)
    for slot in state_store.SLOTS:
        path = f"{sink.state_path}/slot{slot}/meta"
        old = spark.read.parquet(path).drop("parts").collect()
        spark.createDataFrame([tuple(old[0])], "n_rows long, features string, upto long").write.mode("overwrite").parquet(path)
    assert state_store.load_state(spark, sink.state_path, before=2) == (None, None)
    sink(observed(spark, 900, 1_000), 2)
    state, upto = state_store.load_state(spark, sink.state_path, before=3)
    assert (state.n_rows, state.rows.count(), upto) == (1_000, 1_000, 2)


def test_bounded_and_whole_states_do_not_mix(spark):
    df = observed(spark, 0, 300)
    root = work_dir(spark, "test-bounded")
    state = state_store.save_state(spark, training.merged(None, df, calibration=200, **ARGS), root, 0)
    assert state.rows is None and state.samples.where("tree_id < 0").count() == 200
    with pytest.raises(ValueError, match="bound"):
        training.merged(state, df, **ARGS)


def test_a_model_that_fails_on_the_executors_keeps_the_batch(spark, monkeypatch):
    base = work_dir(spark, "test-broken")
    sink = jobs.RecordSink(base, retrain_every=100, fit_args=ARGS)
    sink(batch(spark), 0)
    before = history.read_history(spark, sink.anomalies_path, anomalies=True).count()

    @F.pandas_udf("double")
    def broken(x: pd.Series) -> pd.Series:
        raise ValueError("damaged model")

    monkeypatch.setattr(jobs.anom, "apply_model", lambda df, model: df.withColumn(
        "anomaly_score", broken(F.col("temperature"))).withColumn("is_anomaly", F.col("anomaly_score") < 0))
    base_in = f"{base}/in"
    messages.encode_messages(weather_view(spark, SF001), offset_col="event_id").write.parquet(base_in)
    obs = jobs.observation_stream(spark, fmt="parquet", path=base_in, keep=("offset",))
    sink2 = jobs.RecordSink(base, retrain_every=100, fit_args=ARGS)
    sink2._model_for = lambda spark, batch_id: "damaged"
    q = jobs.run_available_now(jobs.start_record_sink(obs, sink2, f"{base}/ck", trigger="available_now"))
    assert q.exception() is None                                           # the stream committed its batch
    assert history.read_history(spark, sink.records_path).count() > 0
    assert history.read_history(spark, sink.anomalies_path, anomalies=True).count() == before
    err = spark.read.parquet(f"{sink.errors_path}/scoring").collect()
    assert len(err) == 1 and err[0]["step"] == "scoring" and "damaged model" in err[0]["message"]


def test_storage_faults_fail_the_batch_also_while_scoring(spark, monkeypatch):
    sink = jobs.RecordSink(work_dir(spark, "test-storage"), fit_args=ARGS)

    def unreadable(*a):
        raise OSError("store not reachable")
    monkeypatch.setattr(sink, "_model_for", unreadable)
    with pytest.raises(OSError):
        sink(batch(spark), 0)
    gone = spark.read.schema("v double").parquet(_vanished(spark))
    with pytest.raises(Exception) as e:  # noqa: PT011
        gone.collect()
    assert jobs.is_storage_fault(e.value)


def _vanished(spark):
    """A table whose file is damaged."""
    import glob
    path = work_dir(spark, "test-vanished")
    spark.range(5).selectExpr("id * 1.5D AS v").coalesce(1).write.parquet(path)
    for f in glob.glob(f"{path.removeprefix('file:')}/part-*"):
        with open(f, "r+b") as h:
            h.write(b"damaged!")
            h.seek(-8, 2)
            h.write(b"damaged!")
    return path


def test_last_rows_open_the_newest_batches_only(spark):
    path = work_dir(spark, "test-manifest")
    df = clean(spark, SF001).drop("event_id")
    for b in (0, 1, 2, 998, 1000, 2001):
        history.write_batch(df.limit(100 + b % 7), path, b)
    history.write_batch(df.where("false"), path, 2002)
    m = {r["batch_id"]: r for r in history.manifest(spark, path).collect()}
    assert [m[b]["n_rows"] for b in (0, 1, 2, 998, 1000, 2001, 2002)] == [100, 101, 102, 104, 106, 106, 0]
    got = df.limit(100).agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    assert (m[0]["t_min"], m[0]["t_max"]) == (got["a"], got["b"])
    assert history.newest_batches(spark, path, 200) == [2001, 1000]
    assert history.newest_batches(spark, path, 10**6) == [2001, 1000, 998, 2, 1, 0]
    assert history.batches_after(spark, path, 2, 1500) == [998, 1000] and history.batches_after(spark, path, None, 1) == [0, 1]
    last = history.last_n(spark, path, 150)
    assert last.count() == 150 and {f.split("batch_id=")[1].split("/")[0] for f in last.inputFiles()} == {"2001", "1000"}
    want = history.history_last_n(history.read_history(spark, path), 150)
    assert sorted(map(repr, last.collect())) == sorted(map(repr, want.select(*last.columns).collect()))
    assert history.read_history(spark, path).count() == 619                 # the manifest is no part of the table
    history.write_batch(df.limit(7), path, 2001)                            # a replay replaces its row
    assert history.newest_batches(spark, path, 8) == [2001, 1000]
    plain = work_dir(spark, "test-no-manifest")
    df.limit(30).withColumn("batch_id", F.lit(4).cast("long")).withColumn("row_hash", F.lit(1).cast("long")) \
        .write.partitionBy("batch_id").parquet(plain)
    assert history.newest_batches(spark, plain, 5) is None and history.last_n(spark, plain, 5).count() == 5
