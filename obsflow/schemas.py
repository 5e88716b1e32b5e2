"""Schemas of the observation data model.

All record fields are nullable, as in the source system; nothing is inferred.
"""

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# ---- Fixed values: names, types and order of the fields ----------------------
# Observation record: 17 flat fields.
RECORD_SCHEMA = StructType([
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("feels_like", DoubleType(), True),
    StructField("temp_min", DoubleType(), True),
    StructField("temp_max", DoubleType(), True),
    StructField("humidity", IntegerType(), True),
    StructField("pressure", IntegerType(), True),
    StructField("wind_speed", DoubleType(), True),
    StructField("wind_deg", IntegerType(), True),
    StructField("wind_gust", DoubleType(), True),
    StructField("clouds", IntegerType(), True),
    StructField("visibility", IntegerType(), True),
    StructField("weather_id", IntegerType(), True),
    StructField("weather_main", StringType(), True),
    StructField("weather_description", StringType(), True),
])
RECORD_FIELDS = [f.name for f in RECORD_SCHEMA.fields]

# Anomaly record: an observation with its verdict.
ANOMALY_SCHEMA = StructType(RECORD_SCHEMA.fields + [
    StructField("anomaly_label", IntegerType(), True),
    StructField("anomaly_score", DoubleType(), True),
    StructField("is_anomaly", BooleanType(), True),
])

# Shape of a Kafka row (what readStream.format("kafka") produces).
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

# Raw weather API payload (only the parts that are mapped).
PAYLOAD_SCHEMA = StructType([
    StructField("main", StructType([
        StructField("temp", DoubleType(), True),
        StructField("feels_like", DoubleType(), True),
        StructField("temp_min", DoubleType(), True),
        StructField("temp_max", DoubleType(), True),
        StructField("humidity", IntegerType(), True),
        StructField("pressure", IntegerType(), True),
    ]), True),
    StructField("wind", StructType([
        StructField("speed", DoubleType(), True),
        StructField("deg", IntegerType(), True),
        StructField("gust", DoubleType(), True),
    ]), True),
    StructField("clouds", StructType([StructField("all", IntegerType(), True)]), True),
    StructField("visibility", IntegerType(), True),
    StructField("weather", ArrayType(StructType([
        StructField("id", IntegerType(), True),
        StructField("main", StringType(), True),
        StructField("description", StringType(), True),
    ])), True),
])

# Window aggregate rows (the file sink's table).
WINDOW_AGG_SCHEMA = StructType([
    StructField("window_start", StringType(), True),
    StructField("window_end", StringType(), True),
    StructField("city", StringType(), True),
    StructField("avg_temp", DoubleType(), True),
    StructField("max_temp", DoubleType(), True),
    StructField("min_temp", DoubleType(), True),
    StructField("stddev_temp", DoubleType(), True),
    StructField("avg_humidity", DoubleType(), True),
    StructField("avg_pressure", DoubleType(), True),
    StructField("avg_wind_speed", DoubleType(), True),
    StructField("avg_clouds", DoubleType(), True),
    StructField("record_count", LongType(), True),
])
WINDOW_AGG_FIELDS = [f.name for f in WINDOW_AGG_SCHEMA.fields]
# ------------------------------------------------------------------------------

# What a history table adds to its records.
HISTORY_FIELDS = [StructField("event_time", TimestampType(), True), StructField("row_hash", LongType(), True),
                  StructField("batch_id", LongType(), True)]

# Model tables.
FOREST_NODE_SCHEMA = StructType([
    StructField("tree_id", IntegerType(), False),
    StructField("node_id", IntegerType(), False),
    StructField("feature", IntegerType(), False),
    StructField("threshold", DoubleType(), True),
    StructField("left", IntegerType(), False),
    StructField("right", IntegerType(), False),
    StructField("depth", IntegerType(), False),
    StructField("n_rows", IntegerType(), False),
])
