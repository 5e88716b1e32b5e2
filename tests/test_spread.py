"""Work spread over the cores whatever the table's order; rows of the driver without Python workers."""

import datetime as dt

from pyspark.sql import functions as F

from obsflow.operators import forest as iforest
from obsflow.plans import queries as Q
from obsflow.plans.explain import plan_text
from obsflow.sources import messages
from obsflow.sources.tables import local_table, weather_view


def _events_by_time(spark, path, n=4000):
    """Events in one file, in the order of time."""
    rows = spark.range(0, n, 1, 1).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 60_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 17).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 900).cast("double").alias("value"), F.lit("{}").alias("props"))
    rows.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_a_time_range_is_dealt_to_all_cores(spark, tmp_path):
    d = _events_by_time(spark, tmp_path)
    chunks = Q._time_chunks(spark, d, 5)
    whole = messages.encode_messages(weather_view(spark, d), offset_col="event_id", num_partitions=4)
    assert sorted(r for c in chunks for r in map(tuple, c.collect())) == sorted(map(tuple, whole.collect()))
    for chunk in chunks:
        sizes = [r["count"] for r in chunk.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 800 and max(sizes) <= 400


def test_driver_rows_start_no_python_worker(spark):
    schema = "a long, t timestamp, d double, s string"
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, 11, 172425), None, "x"), (None, None, 1.5, None)]
    for some in (rows, []):
        got, want = local_table(spark, some, schema), spark.createDataFrame(some, schema)
        assert got.schema == want.schema and got.collect() == want.collect()
        assert "LocalTableScan" in plan_text(got, "simple")
    nodes = iforest.literal_nodes(spark, Q.FIXED_FOREST)
    assert "ExistingRDD" not in plan_text(nodes, "simple")
    assert [tuple(r) for r in nodes.collect()] == [r for tree in Q.FIXED_FOREST for r in tree]
