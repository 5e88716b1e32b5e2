"""Lookup tables with a default, as small broadcast dimensions.

The dimensions below are fixed and tiny (10 and 9 rows), so broadcasting them
is bounded by construction; the fact side is never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values (must equal the source system's) --------------------------
# Polled cities, in poll order, with their ISO-2 country codes.
CITIES = [
    ("Paris", "FR"), ("London", "GB"), ("Berlin", "DE"), ("Madrid", "ES"),
    ("Rome", "IT"), ("Amsterdam", "NL"), ("Brussels", "BE"), ("Vienna", "AT"),
    ("Zurich", "CH"), ("Stockholm", "SE"),
]
# City -> flag; default for an unknown city.
CITY_FLAGS = {
    "Paris": "🇫🇷", "London": "🇬🇧", "Berlin": "🇩🇪", "Madrid": "🇪🇸",
    "Rome": "🇮🇹", "Amsterdam": "🇳🇱", "Brussels": "🇧🇪", "Vienna": "🇦🇹",
    "Zurich": "🇨🇭", "Stockholm": "🇸🇪",
}
DEFAULT_FLAG = "🏙️"
# Weather condition -> icon; default for an unknown condition.
WEATHER_ICONS = {
    "Clear": "☀️", "Clouds": "☁️", "Rain": "🌧️",
    "Snow": "❄️", "Thunderstorm": "⛈️", "Drizzle": "🌦️",
    "Mist": "🌫️", "Fog": "🌫️", "Haze": "🌫️",
}
DEFAULT_ICON = "🌡️"
# ------------------------------------------------------------------------------


def dimension(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    """A two-column dimension DataFrame from a small fixed mapping (literals, so the planner knows its size)."""
    rows = [F.struct(F.lit(k).alias(key), F.lit(v).alias(value)) for k, v in mapping.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def lookup_with_default(df: DataFrame, dim: DataFrame, on: str, value: str,
                        default: str, out: str | None = None) -> DataFrame:
    """Left-join a lookup dimension and fill misses with ``default``.

    Spark broadcasts the dimension where its size is below the session's
    threshold, so the large side is neither shuffled nor reordered.
    """
    out = out or value
    d = dim.select(F.col(on).alias("__lk"), F.col(value).alias("__lv"))
    joined = df.join(d, df[on] == F.col("__lk"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__lv"), F.lit(default))).drop("__lk", "__lv")


def map_lookup(col: Column, mapping: dict[str, str], default: str) -> Column:
    """Same lookup as an inline literal map (no join at all)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, col), F.lit(default))
