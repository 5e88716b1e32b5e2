"""Served tables: plain batch DataFrames over records and window rows.

Per-city results are built with aggregates that combine partially on every
partition, so a city holding a third of all rows costs the same as any other. Top-k per city uses
``row_number() <= k``, which Spark plans with a partial group limit before the
shuffle: at most k rows per city and partition cross the network.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.functions import lookups
from obsflow.functions.text import capitalize_first, clock_text, fixed_1dp, or_placeholder, time_text
from obsflow.session import work_dir

METRICS = ["temperature", "humidity", "pressure", "wind_speed", "clouds"]
LATEST_FIELDS = ["country", "timestamp", "temperature", "feels_like", "temp_min", "temp_max",
                 "humidity", "pressure", "wind_speed", "wind_deg", "wind_gust", "clouds",
                 "visibility", "weather_id", "weather_main", "weather_description"]
#: Ranges of time that the second pass of ``latest_by_city`` reads.
RANGES = 16


def time_ranges(newest: DataFrame, times: list[str], most: int = RANGES) -> list[tuple]:
    """At most ``most`` ranges of time that hold every value of the columns ``times``.

    The values are reduced to the first and last of each day on the executors;
    the driver joins the days, across the smallest gaps first.
    """
    t = F.explode(F.array(*times)).alias("t")
    days = newest.select(t).where("t is not null").groupBy(F.to_date("t").alias("d")).agg(
        F.min("t").alias("a"), F.max("t").alias("b")).orderBy("d").collect()
    gaps = sorted(range(1, len(days)), key=lambda i: days[i - 1]["b"] - days[i]["a"])[:most - 1]
    cuts = [0, *sorted(gaps), len(days)]
    return [(days[i]["a"], days[j - 1]["b"]) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if j > i]


def latest_by_city(df: DataFrame, *, fields: list[str] | None = None, time_col: str = "event_time",
                   key: str = "city", mode: str = "value") -> DataFrame:
    """Latest state per city.

    ``mode="value"``: for each column the newest non-NULL value (a NULL in the
    newest row does not hide an older value). ``mode="row"``: the newest row.
    Rows without time or city are ignored. ``event_time`` is the newest time.
    """
    fields = [f for f in (fields or LATEST_FIELDS) if f in df.columns]
    t = F.col(time_col)
    src = df.where(F.col(key).isNotNull() & t.isNotNull())
    if mode == "row":
        # the newest row; rows tied on time resolve by a hash of the row, never by arrival order
        cols = [F.col(c) for c in fields]
        newest = F.max(F.struct(t.alias("t"), F.xxhash64(*cols).alias("h"), F.struct(*cols).alias("r")))
        return src.groupBy(key).agg(newest.alias("__n")).select(
            key, *[F.col(f"__n.r.{c}").alias(c) for c in fields], F.col("__n.t").alias(time_col))
    # Pass 1: per column the newest time with a value, and the newest time; fixed-width buffers, so a hash
    # aggregate. The few rows it gives are written once, and bound what pass 2 has to read: a few ranges of
    # time, pushed to the scan, so a city that fell silent long ago adds its own days and not all days since.
    newest = src.groupBy(F.col(key).alias("__k")).agg(
        *[F.max(F.when(F.col(c).isNotNull(), t)).alias(f"__t_{c}") for c in fields], F.max(t).alias("__t"))
    path = work_dir(df.sparkSession, "latest")
    newest.write.parquet(path)
    newest = df.sparkSession.read.parquet(path)
    times = [f"__t_{c}" for c in fields] + ["__t"]
    wanted = [t.between(F.lit(a), F.lit(b)) for a, b in time_ranges(newest, times)]
    recent = src.where(reduce(lambda a, b: a | b, wanted)) if wanted else src
    # Pass 2: the values at those times; rows tied on time resolve to the largest value, whatever their order.
    at = recent.join(newest, F.col(key) == F.col("__k"))
    any_hit = reduce(lambda a, b: a | b, [t == F.col(x) for x in times])
    rows = at.where(any_hit).groupBy(key).agg(
        *[F.max(F.when(t == F.col(f"__t_{c}"), F.col(c))).alias(c) for c in fields], F.max(t).alias(time_col))
    return rows


def current_conditions(latest: DataFrame, *, clock: bool = False) -> DataFrame:
    """KPI cards per city: flag, temperature text, description, icon, caption (and the refresh clock)."""
    flag = lookups.map_lookup(F.col("city"), lookups.CITY_FLAGS, lookups.DEFAULT_FLAG)
    icon = lookups.map_lookup(F.col("weather_main"), lookups.WEATHER_ICONS, lookups.DEFAULT_ICON)
    return latest.select(
        "city",
        flag.alias("flag"),
        F.concat_ws(" ", flag, F.col("city")).alias("label"),
        F.concat(fixed_1dp("temperature"), F.lit("°C")).alias("temperature_text"),
        F.coalesce(capitalize_first("weather_description"), F.lit("")).alias("description"),
        icon.alias("icon"),
        F.concat(icon, F.lit("  💧"), or_placeholder("humidity"), F.lit("%  🌬️"),
                 or_placeholder("wind_speed"), F.lit(" m/s")).alias("caption"),
        *([clock_text().alias("refreshed_at")] if clock else []),
    )


def temperature_series(records: DataFrame, time_col: str = "event_time", *, sort: bool = True) -> DataFrame:
    """Temperature over time, oldest first (``sort=False`` when the consumer orders or aggregates anyway)."""
    out = records.where(F.col(time_col).isNotNull()).select(
        time_text(time_col).alias("event_time"), "city", "temperature", *(
            ["event_id"] if "event_id" in records.columns else []))
    return out.orderBy("event_time", "city") if sort else out


def first_cities(df: DataFrame, n: int = 5, key: str = "city") -> DataFrame:
    """The first ``n`` cities in alphabetical order (a bounded, limited set)."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)


def dual_series(records: DataFrame, n_cities: int = 5, time_col: str = "event_time", *,
                sort: bool = True) -> DataFrame:
    """Humidity and pressure series of the first ``n`` cities, long form with axis labels, oldest first.

    The city set is a limited subquery (at most ``n`` rows), joined left-semi
    with a broadcast: its size is bounded by ``n``, not by the data.
    """
    timed = records.where(F.col(time_col).isNotNull())
    cities = F.broadcast(first_cities(timed, n_cities))
    picked = timed.join(cities, "city", "left_semi")
    ids = ["event_time", "city"] + (["event_id"] if "event_id" in records.columns else [])
    long = picked.select(
        time_text(time_col).alias("event_time"), "city",
        *(["event_id"] if "event_id" in records.columns else []),
        F.col("humidity").cast("double").alias("humidity"),
        F.col("pressure").cast("double").alias("pressure"),
    ).unpivot(ids, ["humidity", "pressure"], "metric", "value")
    out = long.select(
        "*",
        F.when(F.col("metric") == "humidity", F.lit("Humidity (%)"))
         .otherwise(F.lit("Pressure (hPa)")).alias("axis"),
        F.concat_ws(" ", F.col("city"), F.col("metric")).alias("series"),
    )
    return out.orderBy("event_time", "city", "metric") if sort else out


def wind_ranking(latest: DataFrame) -> DataFrame:
    return latest.select("city", "wind_speed").orderBy(F.desc_nulls_last("wind_speed"), "city")


def city_metric_matrix(latest: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """City x metric, long form (city, metric, value as double)."""
    return latest.select("city", *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(["city"], metrics, "metric", "value")


def city_metric_wide(latest: DataFrame, cities: list[str], metrics: list[str] = METRICS) -> DataFrame:
    """Transposed matrix: one row per metric, one column per known city."""
    return city_metric_matrix(latest, metrics).groupBy("metric").pivot("city", cities).agg(F.first("value"))


def window_series_city(aggs: DataFrame, city: str | None, *, sort: bool = True) -> DataFrame:
    """Average / max / min temperature per window of one city (all cities when None), oldest first."""
    src = aggs if city is None else aggs.where(F.col("city") == F.lit(city))
    out = src.select("window_start", "city", "avg_temp", "max_temp", "min_temp")
    return out.orderBy("window_start", "city") if sort else out


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """Rows ranked 1..k within each group (ties broken by the order given)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def agg_table_tail(aggs: DataFrame, k: int = 20, city: str | None = None, *, sort: bool = True) -> DataFrame:
    """The newest ``k`` windows of each city (or of one city), oldest first."""
    src = aggs if city is None else aggs.where(F.col("city") == F.lit(city))
    out = top_k_per_group(src, ["city"], [F.desc("window_start")], k)
    return out.orderBy("window_start", "city") if sort else out


def distinct_cities(df: DataFrame, time_col: str | None = "event_time") -> DataFrame:
    src = df if time_col is None or time_col not in df.columns else df.where(F.col(time_col).isNotNull())
    return src.select("city").where(F.col("city").isNotNull()).distinct()
