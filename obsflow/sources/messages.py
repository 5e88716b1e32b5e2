"""Kafka-shaped messages and raw weather payloads.

* ``kafka_source`` / ``kafka_sink``: the broker connector is a format name, so
  the same code runs on a file stream of Kafka-shaped rows (tests) and on the
  real ``kafka`` format (cluster with the connector on the class path).
* ``encode_messages``: record -> (key = city, value = JSON) rows.
* ``parse_messages``: value -> typed record, malformed JSON -> NULL fields plus
  a corrupt-record flag, bad timestamps -> NULL (never an error under ANSI).
* ``normalize_payload``: nested API payload -> the 17 flat fields with defaults
  for absent optional keys; unusable payloads are routed to a quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obsflow.functions.text import iso_utc
from obsflow.schemas import MESSAGE_SCHEMA, PAYLOAD_SCHEMA, RECORD_FIELDS, RECORD_SCHEMA

CORRUPT_COL = "_corrupt_record"

# ---- Fixed values: topic name; defaults for absent optional payload keys ----
TOPIC = "weather-data"
DEFAULT_WIND_DEG = 0
DEFAULT_WIND_GUST = 0.0
DEFAULT_VISIBILITY = 10000
# ------------------------------------------------------------------------------


def kafka_source(spark: SparkSession, *, bootstrap: str | None = None, topic: str = TOPIC,
                 fmt: str = "kafka", path: str | None = None, starting_offsets: str = "latest",
                 min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    """Streaming source of Kafka-shaped rows (``key, value, topic, partition, offset, timestamp``).

    ``fmt="kafka"`` subscribes to ``topic`` (requires the connector jar);
    any file format reads Kafka-shaped rows from ``path`` with a fixed schema.
    Messages are keyed by city, so a hot city fills one topic partition:
    ``min_partitions`` lets Spark split such a partition's offset range over
    several tasks, ``max_offsets_per_trigger`` bounds a micro-batch.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = (reader.option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "false"))
        if min_partitions:
            reader = reader.option("minPartitions", str(min_partitions))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    else:
        reader = reader.schema(MESSAGE_SCHEMA)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path) if (fmt != "kafka" and path) else reader.load()


def encode_messages(records: DataFrame, *, topic: str = TOPIC, num_partitions: int = 1,
                    offset_col: str | None = None, time_col: str | None = "event_time") -> DataFrame:
    """Records -> Kafka rows: key = city (UTF-8), value = JSON of the 17 fields.

    NULL fields are left out of the JSON (absent keys), as a JSON encoder of a
    record with missing values does. ``partition`` follows the key, so one
    city's messages stay in order within one partition.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in RECORD_FIELDS]))
    part = (F.pmod(F.xxhash64(F.col("city")), F.lit(num_partitions)).cast("int")
            if num_partitions > 1 else F.lit(0))
    return records.select(
        F.col("city").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        part.alias("partition"),
        (F.col(offset_col).cast("bigint") if offset_col else F.lit(None).cast("bigint")).alias("offset"),
        (F.col(time_col).cast("timestamp") if time_col else F.current_timestamp()).alias("timestamp"),
    )


def kafka_sink(messages: DataFrame, *, bootstrap: str, topic: str = TOPIC, checkpoint: str | None = None):
    """Write encoded messages to Kafka (batch or stream), with an all-replica ack."""
    cols = messages.select("key", "value")
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all",
            "kafka.retries": "3", "kafka.linger.ms": "100"}
    if cols.isStreaming:
        w = cols.writeStream.format("kafka").options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    cols.write.format("kafka").options(**opts).save()
    return None


def parse_once(df: DataFrame, parsed, name: str) -> DataFrame:
    """Add ``parsed`` (an expensive expression such as ``from_json``) as column ``name``,
    evaluated exactly once per row.

    A one-element generator is a barrier for predicate pushdown: later filters on
    the parsed fields stay above it instead of being rewritten into one more
    ``from_json`` per referenced field, and they run inside whole-stage codegen.
    """
    return df.select("*", F.inline(F.array(F.struct(parsed.alias(name)))))


def parse_messages(messages: DataFrame, *, keep: list[str] | None = None,
                   with_corrupt: bool = False, fields: list[str] | None = None) -> DataFrame:
    """Kafka rows -> typed records with ``event_time``.

    PERMISSIVE parse: a value that is no JSON object gives NULL fields, a
    wrongly typed field is NULL on its own. With ``with_corrupt`` two flags tell
    them apart: ``is_malformed`` (no record could be read) and ``has_bad_field``
    (a record was read, but some field had the wrong type). ``fields`` parses
    those record fields only. ``event_time`` is ``try_to_timestamp(timestamp)``.
    """
    keep = [F.col(c) for c in (keep or [])]
    wanted = [f for f in RECORD_SCHEMA.fields if fields is None or f.name in fields]
    schema = StructType(wanted + ([StructField(CORRUPT_COL, StringType(), True)] if with_corrupt else []))
    opts = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": CORRUPT_COL} if with_corrupt else {})
    text = F.col("value").cast("string")
    d = F.from_json(text, schema, opts)
    out = parse_once(messages.select(*keep, "value"), d, "__d")
    out = out.select(*keep, *([F.col("value")] if with_corrupt else []), "__d.*")
    out = out.withColumn("event_time", F.try_to_timestamp(F.col("timestamp"))) if "timestamp" in out.columns else out
    if with_corrupt:
        # only values the parser complained about are looked at again
        bad = F.col(CORRUPT_COL).isNotNull()
        is_object = F.json_object_keys(text).isNotNull()
        out = out.withColumn("is_malformed", F.col("value").isNull() | (bad & ~is_object)) \
            .withColumn("has_bad_field", F.col("value").isNotNull() & bad & is_object).drop(CORRUPT_COL, "value")
    return out


def encode_payloads(records: DataFrame, *, passthrough: list[str] | None = None,
                    absent_wind_when=None) -> DataFrame:
    """Records -> raw API-shaped payload JSON (the inverse of ``normalize_payload``).

    ``absent_wind_when`` is a boolean Column; where true ``wind.deg`` and
    ``wind.gust`` are left out of the payload.
    """
    deg, gust = F.col("wind_deg"), F.col("wind_gust")
    if absent_wind_when is not None:
        deg = F.when(absent_wind_when, F.lit(None).cast("int")).otherwise(deg)
        gust = F.when(absent_wind_when, F.lit(None).cast("double")).otherwise(gust)
    payload = F.struct(
        F.struct(F.col("temperature").alias("temp"), "feels_like", "temp_min", "temp_max",
                 "humidity", "pressure").alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), deg.alias("deg"), gust.alias("gust")).alias("wind"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        F.col("visibility"),
        F.array(F.struct(F.col("weather_id").alias("id"), F.col("weather_main").alias("main"),
                         F.col("weather_description").alias("description"))).alias("weather"),
    )
    return records.select(*(passthrough or []), "city", "country",
                          F.try_to_timestamp(F.col("timestamp")).alias("polled_at"),
                          F.to_json(payload).alias("payload"))


_PAYLOAD_PARSE = StructType(PAYLOAD_SCHEMA.fields + [StructField(CORRUPT_COL, StringType(), True)])


def _normalized(raw: DataFrame, payload_col: str, polled_at_col: str | None) -> DataFrame:
    p = F.from_json(F.col(payload_col), _PAYLOAD_PARSE,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    base = parse_once(raw, p, "__p")
    w0 = F.get(F.col("__p.weather"), 0)
    polled = F.col(polled_at_col) if polled_at_col else F.current_timestamp()
    empty = F.col("__p").isNull() | (F.col(f"__p.{CORRUPT_COL}").isNotNull() & F.col("__p.main").isNull()
                                     & F.col("__p.wind").isNull() & F.col("__p.weather").isNull())
    reason = (F.when(empty, F.lit("unparseable"))
              .when(F.col("__p.main").isNull(), F.lit("missing main"))
              .when(F.col("__p.wind").isNull(), F.lit("missing wind"))
              .when(F.col("__p.clouds").isNull(), F.lit("missing clouds"))
              .when(w0.isNull(), F.lit("missing weather")))
    others = [c for c in raw.columns if c not in (payload_col, polled_at_col, "city", "country")]
    return base.select(
        *others,
        F.col("city"), F.col("country"), iso_utc(polled).alias("timestamp"),
        F.col("__p.main.temp").alias("temperature"),
        F.col("__p.main.feels_like").alias("feels_like"),
        F.col("__p.main.temp_min").alias("temp_min"),
        F.col("__p.main.temp_max").alias("temp_max"),
        F.col("__p.main.humidity").alias("humidity"),
        F.col("__p.main.pressure").alias("pressure"),
        F.col("__p.wind.speed").alias("wind_speed"),
        F.coalesce(F.col("__p.wind.deg"), F.lit(DEFAULT_WIND_DEG)).alias("wind_deg"),
        F.coalesce(F.col("__p.wind.gust"), F.lit(DEFAULT_WIND_GUST)).alias("wind_gust"),
        F.col("__p.clouds.all").alias("clouds"),
        F.coalesce(F.col("__p.visibility"), F.lit(DEFAULT_VISIBILITY)).alias("visibility"),
        w0["id"].alias("weather_id"),
        w0["main"].alias("weather_main"),
        w0["description"].alias("weather_description"),
        reason.alias("reject_reason"),
        F.col(payload_col).alias("__raw"),
    )


def normalize_payload(raw: DataFrame, *, payload_col: str = "payload",
                      polled_at_col: str | None = "polled_at") -> DataFrame:
    """Raw payload rows (``city, country, polled_at, payload``) -> flat records.

    Absent ``wind.deg``/``wind.gust``/``visibility`` get 0 / 0.0 / 10000 (a JSON
    ``null`` is treated the same way). Payloads without ``main``, ``wind``,
    ``clouds`` or a first ``weather`` element are not returned; see
    ``quarantined_payloads``. Other input columns are carried along.
    """
    return _normalized(raw, payload_col, polled_at_col) \
        .where(F.col("reject_reason").isNull()).drop("reject_reason", "__raw")


def quarantined_payloads(raw: DataFrame, *, payload_col: str = "payload",
                         polled_at_col: str | None = "polled_at") -> DataFrame:
    """Rows ``normalize_payload`` rejects, with the raw payload and the reason."""
    n = _normalized(raw, payload_col, polled_at_col).where(F.col("reject_reason").isNotNull())
    others = [c for c in raw.columns if c not in (payload_col, polled_at_col, "city", "country")]
    return n.select(*others, "city", "country", F.col("__raw").alias(payload_col), "reject_reason")
