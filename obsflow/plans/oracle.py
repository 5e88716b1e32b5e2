"""DuckDB SQL that states the expected result of each registered query.

Every statement reads the pre-registered ``events`` view through the fixture
derivation ``wv`` (FIXTURES.md section 2). Numeric conventions follow the
Spark side exactly: averages over exact decimals, times rendered as text.
"""

from __future__ import annotations

WV = """
b AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS v100
  FROM events),
wv AS (
SELECT
  CASE user_id % 10 WHEN 0 THEN 'Paris' WHEN 1 THEN 'London' WHEN 2 THEN 'Berlin' WHEN 3 THEN 'Madrid'
    WHEN 4 THEN 'Rome' WHEN 5 THEN 'Amsterdam' WHEN 6 THEN 'Brussels' WHEN 7 THEN 'Vienna'
    WHEN 8 THEN 'Zurich' ELSE 'Stockholm' END AS city,
  CASE user_id % 10 WHEN 0 THEN 'FR' WHEN 1 THEN 'GB' WHEN 2 THEN 'DE' WHEN 3 THEN 'ES'
    WHEN 4 THEN 'IT' WHEN 5 THEN 'NL' WHEN 6 THEN 'BE' WHEN 7 THEN 'AT'
    WHEN 8 THEN 'CH' ELSE 'SE' END AS country,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
  CAST(v100 % 8500 AS DOUBLE) / 100 - 20 AS temperature,
  CAST(v100 % 8500 - 150 AS DOUBLE) / 100 - 20 AS feels_like,
  CAST(v100 % 8500 - 200 AS DOUBLE) / 100 - 20 AS temp_min,
  CAST(v100 % 8500 + 200 AS DOUBLE) / 100 - 20 AS temp_max,
  CAST((event_id * 7 + v100) % 104 AS INT) AS humidity,
  CAST(860 + (event_id * 13) % 240 AS INT) AS pressure,
  CAST((event_id * 17) % 400 - 5 AS DOUBLE) / 10 AS wind_speed,
  CAST((event_id * 11) % 360 AS INT) AS wind_deg,
  CAST((event_id * 19) % 500 AS DOUBLE) / 10 AS wind_gust,
  CAST((event_id * 3) % 101 AS INT) AS clouds,
  CASE WHEN event_id % 97 = 0 THEN NULL
    ELSE CAST((event_id * 31) % 10050 - 20 AS INT) END AS visibility,
  CASE event_type WHEN 'click' THEN 800 WHEN 'view' THEN 803 WHEN 'purchase' THEN 500
    WHEN 'signup' THEN 701 ELSE 761 END AS weather_id,
  CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds' WHEN 'purchase' THEN 'Rain'
    WHEN 'signup' THEN 'Mist' ELSE 'Dust' END AS weather_main,
  CASE event_type WHEN 'click' THEN 'clear sky' WHEN 'view' THEN 'broken clouds'
    WHEN 'purchase' THEN 'light rain' WHEN 'signup' THEN 'mist' ELSE 'dust' END AS weather_description,
  ts AS event_time,
  event_id
FROM b),
clean AS (
  SELECT * FROM wv
  WHERE temperature BETWEEN -60 AND 60 AND humidity BETWEEN 0 AND 100
    AND pressure BETWEEN 870 AND 1085 AND wind_speed >= 0 AND visibility >= 0)
"""

RECORD_COLS = ("city, country, timestamp, temperature, feels_like, temp_min, temp_max, humidity, "
               "pressure, wind_speed, wind_deg, wind_gust, clouds, visibility, weather_id, "
               "weather_main, weather_description")

TT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"  # time_text


def _avg(c: str, d: int) -> str:
    return mean_sql(f"CAST({c} AS DECIMAL(18,2))", d)


def mean_sql(dec_expr: str, d: int, count_expr: str | None = None) -> str:
    """Mean of an exact decimal expression, snapped to 12 places, rounded half away from zero."""
    n = count_expr or f"count({dec_expr})"
    return f"round((sum({dec_expr})::DOUBLE / {n})::DECIMAL(38,12), {d})::DOUBLE"


def _window_agg(src: str, extra_where: str = "") -> str:
    return f"""
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       city,
       {_avg('temperature', 2)} AS avg_temp,
       max(CAST(temperature AS DECIMAL(18,2)))::DOUBLE AS max_temp,
       min(CAST(temperature AS DECIMAL(18,2)))::DOUBLE AS min_temp,
       round(stddev_samp(temperature)::DECIMAL(18,8), 2)::DOUBLE AS stddev_temp,
       {_avg('humidity', 1)} AS avg_humidity,
       {_avg('pressure', 1)} AS avg_pressure,
       {_avg('wind_speed', 2)} AS avg_wind_speed,
       {_avg('clouds', 1)} AS avg_clouds,
       count(*) AS record_count
FROM {src}
WHERE event_time IS NOT NULL {extra_where}
GROUP BY 1, 2, city"""


ORACLE: dict[str, str] = {}


def register(key: str, body: str) -> None:
    ORACLE[key] = "WITH " + WV.strip() + "\n" + body.strip()


register("clean_records", f"SELECT {RECORD_COLS}, event_id FROM clean")
register("window_aggregates", _window_agg("wv"))
register("window_aggregates_clean", _window_agg("clean"))

_TT = lambda c: TT.format(c=c)

register("parse_messages", f"""
SELECT city AS msg_key, {RECORD_COLS.replace('visibility', 'CAST(visibility AS DOUBLE) AS visibility')},
       {_TT('event_time')} AS event_time, event_id FROM wv""")

register("encode_messages", """
SELECT city AS key, 'weather-data' AS topic, event_id,
       CASE WHEN visibility IS NULL THEN 16 ELSE 17 END AS n_keys,
       city AS json_city, temperature AS json_temperature, CAST(visibility AS DOUBLE) AS json_visibility
FROM wv""")

register("normalize_payload", """
SELECT city, country, timestamp, temperature, feels_like, temp_min, temp_max, humidity, pressure,
       wind_speed,
       CASE WHEN event_id % 5 = 0 THEN 0 ELSE wind_deg END AS wind_deg,
       CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE wind_gust END AS wind_gust,
       clouds, coalesce(visibility, 10000) AS visibility,
       weather_id, weather_main, weather_description, event_id
FROM wv""")

_RULES = [("temperature", "temperature BETWEEN -60 AND 60"), ("humidity", "humidity BETWEEN 0 AND 100"),
          ("pressure", "pressure BETWEEN 870 AND 1085"), ("wind_speed", "wind_speed >= 0"),
          ("visibility", "visibility >= 0")]
_KEPT = " AND ".join(f"coalesce({p}, false)" for _, p in _RULES)
register("quality_report", f"""
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN {_KEPT} THEN 1 ELSE 0 END) AS BIGINT) AS n_kept,
       {", ".join(f"CAST(sum(CASE WHEN coalesce({p}, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_bad_{n}" for n, p in _RULES)},
       CAST(0 AS BIGINT) AS n_malformed,
       CAST(sum(CASE WHEN event_time IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_time
FROM wv""")

_BATCH = "CAST(strftime(event_time, '%Y%m%d') AS BIGINT)"
register("records_scan", f"""
SELECT {RECORD_COLS}, event_id, {_TT('event_time')} AS event_time, {_BATCH} AS batch_id FROM clean""")

register("history_last_n", f"""
SELECT {RECORD_COLS}, event_id, {_BATCH} AS batch_id FROM clean
ORDER BY batch_id DESC, event_time DESC LIMIT 2000""")

register("agg_scan", _window_agg("wv"))

_LATEST = ["country", "timestamp", "temperature", "feels_like", "temp_min", "temp_max", "humidity",
           "pressure", "wind_speed", "wind_deg", "wind_gust", "clouds", "visibility", "weather_id",
           "weather_main", "weather_description"]
LAT = ("lat AS (SELECT city, "
       + ", ".join(f"arg_max({c}, event_time) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _LATEST)
       + ", max(event_time) AS event_time FROM clean "
         "WHERE city IS NOT NULL AND event_time IS NOT NULL GROUP BY city)")


def register_lat(key: str, body: str) -> None:
    ORACLE[key] = "WITH " + WV.strip() + ",\n" + LAT + "\n" + body.strip()


register_lat("latest_by_city", f"SELECT city, {', '.join(_LATEST)}, {_TT('event_time')} AS event_time FROM lat")


def _values(mapping: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k, v) for k, v in mapping.items())


def _lookups():
    from obsflow.functions import lookups as L
    return L


_L = _lookups()
register_lat("current_conditions", f"""
, flags(k, v) AS (VALUES {_values(_L.CITY_FLAGS)}),
icons(k, v) AS (VALUES {_values(_L.WEATHER_ICONS)}),
cc AS (
  SELECT lat.*, coalesce(flags.v, '{_L.DEFAULT_FLAG}') AS flag, coalesce(icons.v, '{_L.DEFAULT_ICON}') AS icon
  FROM lat LEFT JOIN flags ON lat.city = flags.k LEFT JOIN icons ON lat.weather_main = icons.k)
SELECT city, flag, flag || ' ' || city AS label,
       CAST(round(CAST(temperature AS DECIMAL(18,2)), 1) AS VARCHAR) || '°C' AS temperature_text,
       coalesce(upper(weather_description[1]) || lower(weather_description[2:]), '') AS description,
       icon,
       icon || '  💧' || coalesce(CAST(humidity AS VARCHAR), '?') || '%  🌬️'
            || coalesce(CAST(wind_speed AS VARCHAR), '?') || ' m/s' AS caption
FROM cc""")

register("temperature_series", f"""
SELECT {_TT('event_time')} AS event_time, city, temperature, event_id FROM clean WHERE event_time IS NOT NULL""")

register_lat("dual_series", f"""
, c5 AS (SELECT city FROM (SELECT DISTINCT city FROM clean WHERE city IS NOT NULL AND event_time IS NOT NULL)
         ORDER BY city LIMIT 5),
picked AS (SELECT * FROM clean WHERE event_time IS NOT NULL AND city IN (SELECT city FROM c5)),
long AS (
  SELECT event_time, city, event_id, 'humidity' AS metric, CAST(humidity AS DOUBLE) AS value FROM picked
  UNION ALL
  SELECT event_time, city, event_id, 'pressure' AS metric, CAST(pressure AS DOUBLE) AS value FROM picked)
SELECT {_TT('event_time')} AS event_time, city, event_id, metric, value,
       CASE WHEN metric = 'humidity' THEN 'Humidity (%)' ELSE 'Pressure (hPa)' END AS axis,
       city || ' ' || metric AS series
FROM long""")

register_lat("wind_ranking", "SELECT city, wind_speed FROM lat")

register_lat("city_metric_matrix", " UNION ALL ".join(
    f"SELECT city, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM lat"
    for m in ["temperature", "humidity", "pressure", "wind_speed", "clouds"]))

ORACLE["window_series_city"] = ("WITH " + WV.strip() + ",\nwa AS (" + _window_agg("wv") + ")\n"
                                "SELECT window_start, city, avg_temp, max_temp, min_temp FROM wa WHERE city = 'Paris'")
ORACLE["agg_table_tail"] = ("WITH " + WV.strip() + ",\nwa AS (" + _window_agg("wv") + ")\n"
                            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
                            "(PARTITION BY city ORDER BY window_start DESC) AS rn FROM wa) WHERE rn <= 20")

register("distinct_cities", "SELECT DISTINCT city FROM wv WHERE event_time IS NOT NULL AND city IS NOT NULL")

register("lookup_default", f"""
, flags(k, v) AS (VALUES {_values(_L.CITY_FLAGS)}),
icons(k, v) AS (VALUES {_values(_L.WEATHER_ICONS)})
SELECT wv.event_id, wv.city, coalesce(flags.v, '{_L.DEFAULT_FLAG}') AS flag, wv.weather_main,
       coalesce(icons.v, '{_L.DEFAULT_ICON}') AS icon
FROM wv LEFT JOIN flags ON wv.city = flags.k LEFT JOIN icons ON wv.weather_main = icons.k""")

register("threshold_label", """
SELECT event_id, temperature,
       CASE WHEN temperature IS NULL THEN NULL WHEN temperature >= 0 THEN 'normal' ELSE 'inverse' END AS label
FROM wv""")

ORACLE_MINUTE = """
SELECT strftime(time_bucket(INTERVAL 1 MINUTE, event_time), '%Y-%m-%d %H:%M:%S') AS cycle_start,
       count(DISTINCT city) AS n_cities, count(*) AS n_records,
       count(DISTINCT city) / 10 AS completeness,
       (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6 AS elapsed_sec
FROM wv WHERE event_time IS NOT NULL GROUP BY 1"""
register("poll_completeness_minute", ORACLE_MINUTE)
register("poll_completeness", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, event_time), '%Y-%m-%d %H:%M:%S') AS cycle_start,
       count(DISTINCT city) AS n_cities, count(*) AS n_records,
       count(DISTINCT city) / 10 AS completeness,
       (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6 AS elapsed_sec
FROM wv WHERE event_time IS NOT NULL GROUP BY 1""")

register("delivery_by_cycle", """
, g AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS c, count(DISTINCT city) AS n_cities, count(*) AS n_records,
         count(DISTINCT city) / 10 AS completeness,
         (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6 AS elapsed_sec
  FROM wv WHERE event_time IS NOT NULL GROUP BY 1
), spine AS (SELECT unnest(generate_series((SELECT min(c) FROM g), (SELECT max(c) FROM g), INTERVAL 1 MINUTE)) AS c)
SELECT strftime(spine.c, '%Y-%m-%d %H:%M:%S') AS cycle_start, coalesce(n_cities, 0) AS n_cities,
       coalesce(n_records, 0) AS n_records, coalesce(completeness, 0.0) AS completeness, elapsed_sec, g.c IS NULL AS silent
FROM spine LEFT JOIN g USING (c)""")

_FEATS = ["temperature", "humidity", "pressure", "wind_speed", "clouds"]
_MED = "med AS (SELECT " + ", ".join(f"round(median(CAST({f} AS DOUBLE)), 6) AS m_{f}" for f in _FEATS) + " FROM clean)"
_STATS = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, (SELECT count({f}) FROM clean) AS n, (SELECT m_{f} FROM med) AS median,
       {mean_sql("CAST(x AS DECIMAL(18,2))", 6)} AS mean, round(stddev_pop(x), 6) AS std_pop
FROM (SELECT coalesce(CAST({f} AS DOUBLE), (SELECT m_{f} FROM med)) AS x FROM clean)""" for f in _FEATS)
register("feature_stats", f", {_MED}\n{_STATS}")

register("standardize", f""", {_MED},
st AS ({_STATS})
SELECT event_id, """ + ", ".join(
    f"""(coalesce(CAST({f} AS DOUBLE), (SELECT median FROM st WHERE feature = '{f}'))
        - (SELECT mean FROM st WHERE feature = '{f}'))
       / (SELECT CASE WHEN std_pop = 0 OR std_pop IS NULL THEN 1.0 ELSE std_pop END FROM st WHERE feature = '{f}')
       AS z_{f}""" for f in _FEATS) + " FROM clean")

register("feature_deviation", f", {_MED}\n" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature,
       {mean_sql(f"abs(CAST({f} AS DECIMAL(18,2)) - CAST(m_{f} AS DECIMAL(18,3)))", 6)} AS mad
FROM clean, med""" for f in _FEATS))

_MEDC = ("medc AS (SELECT city, " + ", ".join(f"round(median(CAST({f} AS DOUBLE)), 6) AS m_{f}" for f in _FEATS)
         + " FROM clean GROUP BY city)")
register("feature_deviation_by_city", f", {_MEDC}\n" + " UNION ALL ".join(
    f"""SELECT c.city, '{f}' AS feature,
       {mean_sql(f"abs(CAST(c.{f} AS DECIMAL(18,2)) - CAST(m.m_{f} AS DECIMAL(18,3)))", 6)} AS mad
FROM clean c JOIN medc m ON c.city = m.city GROUP BY c.city""" for f in _FEATS))

register("histogram_by_city", """
, mm AS (SELECT min(temperature) AS lo, max(temperature) AS hi FROM clean),
h AS (SELECT city, CAST(least(floor((temperature - lo) / ((hi - lo) / 20)) + 1, 20) AS INT) AS bin
      FROM clean, mm WHERE temperature IS NOT NULL)
SELECT city, bin, CAST(lo + (bin - 1) * ((hi - lo) / 20) AS DOUBLE) AS bin_start, count(*) AS n
FROM h, mm GROUP BY city, bin, lo, hi""")

_PFLAG = """pf AS (
  SELECT event_id, city, temperature,
         CAST(CASE WHEN temperature < t THEN -1 ELSE 1 END AS INT) AS anomaly_label,
         coalesce(temperature < t, false) AS is_anomaly
  FROM wv, (SELECT quantile_cont(temperature, 0.05) AS t FROM wv))"""
register("percentile_flag", f", {_PFLAG}\nSELECT * FROM pf")
register("anomaly_rate_fixed", f""", {_PFLAG},
agg AS (SELECT count(*) AS n_total, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies FROM pf)
SELECT n_total, n_anomalies,
       coalesce(CAST(n_anomalies AS DOUBLE) * 100.0 / CAST(n_total AS DOUBLE), 0.0) AS anomaly_rate,
       CAST(round(CAST(coalesce(CAST(n_anomalies AS DOUBLE) * 100.0 / CAST(n_total AS DOUBLE), 0.0) AS DECIMAL(18,6)), 1)
            AS VARCHAR) || '%' AS rate_text
FROM agg""")


def _c_sql(n: int) -> str:
    return f"(2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n})"


def _tree_sql(nodes, feats) -> str:
    by_id = {r[1]: r for r in nodes}

    def walk(nid):
        _, _, f, thr, le, ri, depth, n = by_id[nid]
        if f < 0:
            return f"({depth} + {_c_sql(n) if n > 2 else ('1.0' if n == 2 else '0.0')})"
        return f"(CASE WHEN {feats[f]} <= {thr!r} THEN {walk(le)} ELSE {walk(ri)} END)"
    return walk(0)


def _fixed_forest_sql() -> str:
    from obsflow.plans.queries import FIXED_FOREST
    feats = ["temperature", "humidity", "pressure", "wind_speed", "clouds"]
    hs = [_tree_sql(t, feats) for t in FIXED_FOREST]
    total = hs[0]
    for h in hs[1:]:
        total = f"({total} + {h})"
    return f"""
SELECT event_id,
       round(-pow(2.0, -({total} / {len(hs)}.0) / {_c_sql(256)}) * 10000.0) / 10000.0 AS anomaly_score
FROM wv"""


register("forest_score_fixed", _fixed_forest_sql())


def _fixed_detect_sql() -> str:
    body = _fixed_forest_sql().strip()
    raw = body[body.index("round(") + len("round("):body.index(" * 10000.0) / 10000.0 AS anomaly_score")]
    return f"""
, sc AS (SELECT event_id, {raw} AS s FROM wv),
thr AS (SELECT quantile_cont(s, 0.05) AS t FROM sc)
SELECT event_id, round(s * 10000.0) / 10000.0 AS anomaly_score,
       CAST(CASE WHEN s < t THEN -1 ELSE 1 END AS INT) AS anomaly_label,
       coalesce(s < t, false) AS is_anomaly
FROM sc, thr"""


register("detect_anomalies_fixed", _fixed_detect_sql())

_CLOSED = ("WHERE event_time IS NOT NULL AND time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE "
           "<= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM wv)")
register("stream_window_sink", _window_agg("wv", "AND time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE "
                                                 "<= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM wv)"))
ORACLE["stream_restart"] = ORACLE["stream_window_sink"]
register("stream_clean_sink", f"SELECT {RECORD_COLS}, event_id FROM clean")


def _wide_sql() -> str:
    cities = [c for c, _ in _L.CITIES]
    long = " UNION ALL ".join(f"SELECT city, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM lat"
                              for m in ["temperature", "humidity", "pressure", "wind_speed", "clouds"])
    cols = ", ".join(f"max(CASE WHEN city = '{c}' THEN value END) AS \"{c}\"" for c in cities)
    return f", m AS ({long})\nSELECT metric, {cols} FROM m GROUP BY metric"


register_lat("city_metric_wide", _wide_sql())


def _rejected_sql() -> str:
    parts = ", ".join(f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, p in _RULES)
    return f"""
SELECT event_id, city, concat_ws(',', {parts}) AS failed_rules
FROM wv WHERE NOT ({_KEPT})"""


register("rejected_records", _rejected_sql())

register("quarantined_payloads", """
SELECT -event_id - 1 AS event_id, props AS payload, 'missing main' AS reject_reason FROM events""")

ORACLE["stream_quality_report"] = ORACLE["quality_report"]


# ---- the anomaly tables over the literal forest -------------------------------
_RAW = _fixed_forest_sql().strip()
_RAW = _RAW[_RAW.index("round(") + len("round("):_RAW.index(" * 10000.0) / 10000.0 AS anomaly_score")]
_FIXED = f""", raw AS (SELECT *, {_RAW} AS s FROM clean),
sc AS (
  SELECT raw.* EXCLUDE (s), round_even(s * 10000.0, 0) / 10000.0 AS anomaly_score, coalesce(s < t, false) AS is_anomaly,
         CAST(CASE WHEN s < t THEN -1 ELSE 1 END AS INT) AS anomaly_label
  FROM raw, (SELECT quantile_cont(s, 0.05) AS t FROM raw)),
an AS (SELECT * FROM sc WHERE is_anomaly)
"""
_RATE = """SELECT n_total, n_anomalies, CASE WHEN n_total = 0 THEN 0.0 ELSE n_anomalies * 100.0::DOUBLE / n_total END AS anomaly_rate,
       CAST(round(CAST(CASE WHEN n_total = 0 THEN 0.0 ELSE n_anomalies * 100.0::DOUBLE / n_total END AS DECIMAL(18,6)), 1) AS VARCHAR)
       || '%' AS rate_text"""
_RECENT = ["timestamp", "city", "temperature", "humidity", "pressure", "wind_speed", "weather_main", "anomaly_score"]

register("detect_flagged_fixed", f"{_FIXED} SELECT {RECORD_COLS}, event_id, anomaly_score, anomaly_label FROM an")
register("score_summary_fixed", f"""{_FIXED}
SELECT min(anomaly_score) FILTER (WHERE is_anomaly) AS min_flagged_score,
       max(anomaly_score) FILTER (WHERE is_anomaly) AS max_flagged_score,
       count(*) FILTER (WHERE is_anomaly) AS n_flagged, count(*) AS n_total,
       count(*) FILTER (WHERE is_anomaly) / count(*) AS flagged_share FROM sc""")
register("anomaly_details_fixed", f"{_FIXED} SELECT event_id, timestamp, city, anomaly_score, " + ", ".join(
    f"round_even({f}::DOUBLE * 10, 0) / 10 AS {f}" for f in _FEATS) + " FROM an")
register("anomaly_histogram_fixed", f"""{_FIXED}, mm AS (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM an),
h AS (SELECT city, lo, hi, CASE WHEN hi = lo THEN 1 ELSE
        CAST(least(floor((anomaly_score - lo) / ((hi - lo) / 20)) + 1, 20) AS INT) END AS bin FROM an, mm)
SELECT city, bin, CAST(lo + (bin - 1) * ((hi - lo) / 20) AS DOUBLE) AS bin_start, count(*) AS n FROM h GROUP BY city, bin, lo, hi""")
register("recent_anomalies_fixed", f"""{_FIXED}
SELECT {", ".join(_RECENT)} FROM (SELECT * FROM an ORDER BY event_time DESC, city DESC, event_id DESC LIMIT 20)""")
register("anomaly_scan", f"""{_FIXED}
SELECT {RECORD_COLS}, event_id, anomaly_label, anomaly_score, {_TT('event_time')} AS event_time FROM an""")
register("anomaly_rate_history_fixed", f"""{_FIXED},
c AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE is_anomaly) AS n_anomalies FROM sc) {_RATE} FROM c""")
register("anomaly_rate_capped_fixed", f"""{_FIXED},
c AS (SELECT least(count(*), 2000) AS n_total, least(count(*) FILTER (WHERE is_anomaly), 500) AS n_anomalies FROM sc) {_RATE} FROM c""")
register("forest_roundtrip", f"""{_FIXED} SELECT event_id, round_even(s * 10000.0, 0) / 10000.0 AS anomaly_score,
       CAST(CASE WHEN s < -0.5 THEN -1 ELSE 1 END AS INT) AS anomaly_label FROM raw""")
register("stream_anomalies_fixed", f"""{_FIXED} SELECT event_id, city, round_even(s * 10000.0, 0) / 10000.0 AS anomaly_score,
       -1 AS anomaly_label FROM raw WHERE s < -0.5""")
register("forest_invariants", """SELECT CAST(t AS INT) AS tree_id, least(256, n) AS root_rows, least(256, n) AS leaf_rows,
       true AS depth_ok, CAST(0 AS BIGINT) AS bad_splits
FROM (SELECT count(*) AS n FROM clean), range(100) r(t)""")
register("forest_flag_share", """SELECT count(*) AS n_rows, count(*) AS n_scored, true AS flags_bounded,
       true AS flags_lowest, true AS in_range FROM clean""")

# The stream reads five equal time ranges in the order 2, 0, 4, 1, 3. A run first aggregates its rows with the
# watermark the runs before left behind (10 minutes below the latest time seen) and drops rows whose window that
# watermark has passed; at its end the watermark rises and the windows it has passed are given out.
_LATE_ORDER = [2, 0, 4, 1, 3]


def _runs_sql() -> str:
    ranks = " ".join(f"WHEN {c} THEN {i}" for i, c in enumerate(_LATE_ORDER))
    return f""", ab AS (SELECT epoch_us(min(event_time)) AS a, epoch_us(max(event_time)) AS b FROM wv),
ch AS (SELECT wv.*, CASE (epoch_us(event_time) - a) // ((b - a) // 5 + 1) {ranks} END AS run,
              time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS w_end FROM wv, ab),
mx AS (SELECT run, max(event_time) AS m FROM ch GROUP BY run),
wm AS (SELECT run, max(m) OVER (ORDER BY run) - INTERVAL 10 MINUTE AS after_run,
              max(m) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS before_run FROM mx)"""


def _late_sql() -> str:
    return f"""{_runs_sql()},
late AS (SELECT ch.* EXCLUDE (run, w_end) FROM ch JOIN wm USING (run)
         WHERE (before_run IS NULL OR w_end > before_run) AND w_end <= (SELECT max(after_run) FROM wm))
{_window_agg("late")}"""


register("stream_late_data", _late_sql())
register("stream_input_quality", f"""{_runs_sql()}
SELECT CAST(run AS BIGINT) AS batch_id, count(*) AS rows_in, count(*) FILTER (WHERE event_time IS NULL) AS null_time,
       count(*) FILTER (WHERE w_end <= before_run) AS late_rows FROM ch JOIN wm USING (run) GROUP BY run""")
