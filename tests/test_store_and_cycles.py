"""Crash-safe pruning of the model store; delivery over silent cycles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.operators import anomalies as anom
from obsflow.operators import windows
from obsflow.operators.quality import clean_records
from obsflow.session import work_dir
from obsflow.sources import model_store
from obsflow.sources.tables import weather_view
from tests.conftest import SF001


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["commit", "remove-1", "remove-3"])
def test_pruning_that_stops_half_way_keeps_the_newest_model(spark, monkeypatch, step):
    root = work_dir(spark, "test-crash")
    model = anom.fit_model(clean_records(weather_view(spark, SF001)), n_trees=3)
    for v in range(3):
        model_store.save_model(spark, model, root, v)
    done = []

    def stop(*a):
        done.append(a)
        if step == "commit" or len(done) == int(step[-1]):
            raise Stopped
        return real(*a)
    name = "_commit_generation" if step == "commit" else "_remove"
    real = getattr(model_store, name)
    monkeypatch.setattr(model_store, name, stop)
    with pytest.raises(Stopped):
        model_store.prune_versions(spark, root, keep=1)
    monkeypatch.setattr(model_store, name, real)
    got = model_store.load_model(spark, root)
    assert got.version == 2 and got.threshold == model.threshold
    model_store.save_model(spark, model, root, 3)                       # the store goes on
    assert model_store.prune_versions(spark, root, keep=2) == [2, 3]
    assert model_store.load_model(spark, root).version == 3 and model_store.load_model(spark, root, 1) is None
    assert sorted(model_store.load_model(spark, root, 2).forest.extra["nodes"]) == sorted(model.forest.extra["nodes"])


def test_silent_cycles_are_rows_of_zeros(spark):
    t = lambda m, s=0: dt.datetime(2024, 1, 1, 10, m, s)
    df = spark.createDataFrame([("A", t(1)), ("B", t(1, 30)), ("A", t(1, 59)), ("A", t(5)), (None, t(5, 1)), ("A", None)],
                               "city string, event_time timestamp")
    rows = windows.delivery_by_cycle(df, expected=2).orderBy("cycle_start").collect()
    assert [(r["cycle_start"][-8:], r["n_cities"], r["n_records"], r["completeness"], r["silent"]) for r in rows] == [
        ("10:01:00", 2, 3, 1.0, False), ("10:02:00", 0, 0, 0.0, True), ("10:03:00", 0, 0, 0.0, True),
        ("10:04:00", 0, 0, 0.0, True), ("10:05:00", 1, 2, 0.5, False)]
    assert rows[0]["elapsed_sec"] == 59.0 and rows[1]["elapsed_sec"] is None
    us = lambda x: int(x.replace(tzinfo=dt.timezone.utc).timestamp() * 10**6)
    wide = windows.delivery_by_cycle(df, start=us(t(0)), end=us(t(7)), cycle="2 minutes").orderBy("cycle_start").collect()
    assert [(r["cycle_start"][-8:], r["n_records"]) for r in wide] == [("10:00:00", 3), ("10:02:00", 0), ("10:04:00", 2), ("10:06:00", 0)]
    none = df.where("false")
    assert windows.delivery_by_cycle(none).collect() == []
    assert [r["n_records"] for r in windows.delivery_by_cycle(none, start=us(t(0)), end=us(t(1))).collect()] == [0, 0]
    years = windows.cycle_spine(spark, 0, 2 * 365 * 86_400 * 10**6)
    assert years.rdd.getNumPartitions() > 500 and years.agg(F.count_distinct("cycle_start")).first()[0] == 2 * 365 * 1440 + 1
