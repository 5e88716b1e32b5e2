"""Reading the input tables and deriving observation records from ``events``.

``weather_view`` is the documented fixture derivation (FIXTURES.md section 2):
one observation per event, whose work grows with the events table. It is a
pure projection, so it stays inside one codegen stage with the scan and every
filter above it is pushed to the Parquet reader where possible.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, TimestampType

from obsflow.functions.lookups import CITIES
from obsflow.functions.text import iso_utc

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def local_table(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """Rows held by the driver as a table, sent as Arrow.

    A list of tuples given to ``createDataFrame`` starts a Python worker on every
    executor core to unpickle it; this starts none.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = list(zip(*rows, strict=True)) or [()] * len(st)
    # naive times are local ones, as in createDataFrame
    cols = [[v and v.astimezone() for v in c] if isinstance(f.dataType, TimestampType) else c
            for c, f in zip(cols, st.fields, strict=True)]
    arrow = to_arrow_schema(st)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(cols, arrow.types, strict=True)], schema=arrow), st)


def _case(key, pairs, default):
    expr = None
    for k, v in pairs:
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))


# Fixed values of the fixture: event_type -> (weather_id, main, description).
EVENT_WEATHER = [
    ("click", 800, "Clear", "clear sky"),
    ("view", 803, "Clouds", "broken clouds"),
    ("purchase", 500, "Rain", "light rain"),
    ("signup", 701, "Mist", "mist"),
]
OTHER_WEATHER = (761, "Dust", "dust")


def weather_from_events(events: DataFrame, with_ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Observation records (17 fields + event_time [+ event_id] [+ ``keep`` columns]) from events."""
    uid = F.col("user_id") % 10
    eid = F.col("event_id")
    v100 = F.floor(F.col("value") * 100 + 0.5).cast("bigint")
    ts = F.col("ts")
    m = v100 % 8500
    cols = [
        _case(uid, [(i, c) for i, (c, _) in enumerate(CITIES[:-1])], CITIES[-1][0]).alias("city"),
        _case(uid, [(i, k) for i, (_, k) in enumerate(CITIES[:-1])], CITIES[-1][1]).alias("country"),
        iso_utc(ts).alias("timestamp"),
        (m.cast("double") / 100 - 20).alias("temperature"),
        ((m - 150).cast("double") / 100 - 20).alias("feels_like"),
        ((m - 200).cast("double") / 100 - 20).alias("temp_min"),
        ((m + 200).cast("double") / 100 - 20).alias("temp_max"),
        ((eid * 7 + v100) % 104).cast("int").alias("humidity"),
        (860 + (eid * 13) % 240).cast("int").alias("pressure"),
        (((eid * 17) % 400 - 5).cast("double") / 10).alias("wind_speed"),
        ((eid * 11) % 360).cast("int").alias("wind_deg"),
        (((eid * 19) % 500).cast("double") / 10).alias("wind_gust"),
        ((eid * 3) % 101).cast("int").alias("clouds"),
        F.when(eid % 97 == 0, F.lit(None).cast("int"))
         .otherwise(((eid * 31) % 10050 - 20).cast("int")).alias("visibility"),
        _case(F.col("event_type"), [(e, i) for e, i, _, _ in EVENT_WEATHER], OTHER_WEATHER[0])
        .cast("int").alias("weather_id"),
        _case(F.col("event_type"), [(e, mn) for e, _, mn, _ in EVENT_WEATHER], OTHER_WEATHER[1])
        .alias("weather_main"),
        _case(F.col("event_type"), [(e, d) for e, _, _, d in EVENT_WEATHER], OTHER_WEATHER[2])
        .alias("weather_description"),
        ts.cast("timestamp").alias("event_time"),
    ]
    if with_ids:
        cols.append(eid.alias("event_id"))
    cols += [F.col(c) for c in (keep or [])]
    return events.select(*cols)


def weather_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_from_events(read_table(spark, sf_dir, "events"))
