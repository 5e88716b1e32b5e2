"""Tumbling event-time windows: the same function for batch and stream.

Plan shape: partial HashAggregate on every input partition -> Exchange on
(window, city) -> final HashAggregate, all in double arithmetic over the values
as they are. On a stream the watermark bounds the state and append mode emits a
window once it is closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.numeric import rounded_avg, rounded_stddev
from obsflow.operators.quality import DEFAULT_RULES, clean_records

# ---- Fixed values ----------------------------------------------------------
WINDOW = "5 minutes"
WATERMARK = "10 minutes"
# ------------------------------------------------------------------------------


def window_aggregates(df: DataFrame, *, duration: str = WINDOW, time_col: str = "event_time",
                      by: str = "city", clean_first: bool = False, rules=DEFAULT_RULES,
                      watermark: str | None = None) -> DataFrame:
    """Nine statistics per (tumbling window, city).

    ``clean_first=False`` aggregates uncleaned rows, as the source system does;
    ``True`` applies the range rules first. Rows with NULL time fall out (a
    window of NULL is no window). ``watermark`` is required on a stream.
    """
    src = clean_records(df, rules) if clean_first else df
    if watermark:
        src = src.withWatermark(time_col, watermark)
    agg = src.groupBy(F.window(F.col(time_col), duration).alias("window"), F.col(by)).agg(
        rounded_avg("temperature", 2).alias("avg_temp"),
        F.round(F.max("temperature"), 2).alias("max_temp"),
        F.round(F.min("temperature"), 2).alias("min_temp"),
        rounded_stddev("temperature", 2).alias("stddev_temp"),
        rounded_avg("humidity", 1).alias("avg_humidity"),
        rounded_avg("pressure", 1).alias("avg_pressure"),
        rounded_avg("wind_speed", 2).alias("avg_wind_speed"),
        rounded_avg("clouds", 1).alias("avg_clouds"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return agg.select(
        F.col("window.start").cast("string").alias("window_start"),
        F.col("window.end").cast("string").alias("window_end"),
        F.col(by),
        "avg_temp", "max_temp", "min_temp", "stddev_temp", "avg_humidity",
        "avg_pressure", "avg_wind_speed", "avg_clouds", "record_count",
    )


def cycle_spine(spark, start, end, cycle: str = "1 minute", *, chunk: int = 1440) -> DataFrame:
    """(cycle_start): every cycle start from the one that holds ``start`` to the one that holds ``end``.

    Cycles are made in parallel: tasks take chunks of ``chunk`` cycles each from
    a distributed range, so years of minutes are no single-task sequence.
    """
    step = spark.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00' + INTERVAL {cycle}) AS s").first()["s"]
    first, last = start // step, end // step
    parts = max(1, -(-(last - first + 1) // chunk))
    ids = spark.range(first, last + 1, 1, min(parts, 4096))
    return ids.select(F.timestamp_micros(F.col("id") * F.lit(step)).alias("cycle_start"))


def delivery_by_cycle(df: DataFrame, *, cycle: str = "1 minute", expected: int = 10, time_col: str = "event_time",
                      key: str = "city", start=None, end=None) -> DataFrame:
    """``poll_completeness`` over every cycle of the span: a cycle that delivered nothing is a row of zeros.

    The span is that of the data, or from ``start`` to ``end`` (microseconds
    since the epoch), so cycles before the first and after the last record can
    be judged too. Deliveries outside the span are left out. The statistics are
    aggregated per cycle first; the spine meets only their result.
    """
    t = F.col(time_col)
    if start is None or end is None:
        r = df.agg(F.min(F.unix_micros(t)).alias("a"), F.max(F.unix_micros(t)).alias("b")).first()
        start, end = (r["a"] if start is None else start), (r["b"] if end is None else end)
    have = poll_completeness(df, cycle=cycle, expected=expected, time_col=time_col, key=key)
    if start is None or end is None or end < start:
        return have.limit(0)
    spine = cycle_spine(df.sparkSession, start, end, cycle).select(F.col("cycle_start").cast("string").alias("__c"))
    full = spine.join(have, F.col("__c") == F.col("cycle_start"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(have.schema[c].dataType).alias(c)
    return full.select(F.col("__c").alias("cycle_start"), zero("n_cities"), zero("n_records"), zero("completeness"),
                       "elapsed_sec", F.col("cycle_start").isNull().alias("silent"))


def poll_completeness(df: DataFrame, *, cycle: str = "1 minute", expected: int = 10,
                      time_col: str = "event_time", key: str = "city") -> DataFrame:
    """Per poll cycle: distinct cities delivered, share of the expected list, spread in seconds.

    ``count(DISTINCT city)`` is planned as two partial aggregations (by cycle
    and city first), so a hot cycle never holds its raw rows in one task.
    """
    t = F.col(time_col)
    g = df.where(t.isNotNull()).groupBy(F.window(t, cycle).alias("w")).agg(
        F.count_distinct(F.col(key)).alias("n_cities"),
        F.count(F.lit(1)).alias("n_records"),
        F.min(t).alias("t0"), F.max(t).alias("t1"))
    return g.select(
        F.col("w.start").cast("string").alias("cycle_start"),
        "n_cities", "n_records",
        (F.col("n_cities") / F.lit(expected)).alias("completeness"),
        ((F.unix_micros("t1") - F.unix_micros("t0")) / F.lit(1e6)).alias("elapsed_sec"),
    )
