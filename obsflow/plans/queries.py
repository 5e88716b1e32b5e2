"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the given tables (``events`` through the fixture derivation) and
nothing made up, so their work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions import lookups
from obsflow.functions.numeric import exact_quantile
from obsflow.functions.text import threshold_label, time_text
from obsflow.operators import anomalies as anom
from obsflow.operators import features, quality, scoring, serve, windows
from obsflow.operators import forest as iforest
from obsflow.schemas import RECORD_FIELDS
from obsflow.session import work_dir
from obsflow.sources import history, messages, model_store
from obsflow.sources.tables import local_table, read_table, weather_from_events, weather_view
from obsflow.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


@query
def q_clean_records(spark, sf_dir):
    return quality.clean_records(weather_view(spark, sf_dir)).select(*RECORD_FIELDS, "event_id")


@query
def q_window_aggregates(spark, sf_dir):
    return windows.window_aggregates(weather_view(spark, sf_dir))


@query
def q_window_aggregates_clean(spark, sf_dir):
    return windows.window_aggregates(weather_view(spark, sf_dir), clean_first=True)


# ---- ingest ------------------------------------------------------------------



def _messages(spark, sf_dir):
    wv = weather_view(spark, sf_dir)
    return messages.encode_messages(wv, offset_col="event_id", num_partitions=4)


@query
def q_parse_messages(spark, sf_dir):
    parsed = messages.parse_messages(_messages(spark, sf_dir), keep=["key", "offset"])
    # visibility is the one nullable integer: reported as double so any client reads it alike
    fields = [F.col(c).cast("double").alias(c) if c == "visibility" else F.col(c) for c in RECORD_FIELDS]
    return parsed.select(F.col("key").cast("string").alias("msg_key"), *fields,
                         time_text("event_time").alias("event_time"), F.col("offset").alias("event_id"))


@query
def q_encode_messages(spark, sf_dir):
    m = _messages(spark, sf_dir)
    v = F.col("value").cast("string")
    return m.select(
        F.col("key").cast("string").alias("key"), "topic", F.col("offset").alias("event_id"),
        F.size(F.json_object_keys(v)).alias("n_keys"),
        F.get_json_object(v, "$.city").alias("json_city"),
        F.get_json_object(v, "$.temperature").cast("double").alias("json_temperature"),
        F.get_json_object(v, "$.visibility").cast("int").cast("double").alias("json_visibility"))


@query
def q_normalize_payload(spark, sf_dir):
    wv = weather_view(spark, sf_dir)
    raw = messages.encode_payloads(wv, passthrough=["event_id"], absent_wind_when=F.col("event_id") % 5 == 0)
    return messages.normalize_payload(raw).select(*RECORD_FIELDS, "event_id")


@query
def q_quality_report(spark, sf_dir):
    parsed = messages.parse_messages(_messages(spark, sf_dir), with_corrupt=True)
    return quality.quality_report(parsed, malformed_col="is_malformed")


# ---- history tables ----------------------------------------------------------
def _day_batch(df):
    return df.withColumn("batch_id", F.date_format("event_time", "yyyyMMdd").cast("bigint"))


def _clean_history(spark, sf_dir):
    """Cleaned records written as a history table, one batch per day of data."""
    path = work_dir(spark, "records")
    clean = quality.clean_records(weather_view(spark, sf_dir))
    history.write_batches(_day_batch(clean), path)
    return path


@query
def q_records_scan(spark, sf_dir):
    df = history.records_scan(spark, _clean_history(spark, sf_dir))
    return df.select(*RECORD_FIELDS, "event_id", time_text("event_time").alias("event_time"),
                     F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def q_history_last_n(spark, sf_dir):
    hist = history.read_history(spark, _clean_history(spark, sf_dir))
    hist = hist.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return history.history_last_n(hist, 2000).select(*RECORD_FIELDS, "event_id", "batch_id")


@query
def q_agg_scan(spark, sf_dir):
    path = work_dir(spark, "aggregations")
    history.write_window_rows(windows.window_aggregates(weather_view(spark, sf_dir)), path)
    return history.agg_scan(spark, path)


# ---- served tables -------------------------------------------------------------
def _clean(spark, sf_dir):
    return quality.clean_records(weather_view(spark, sf_dir))


def _latest(spark, sf_dir):
    return serve.latest_by_city(_clean(spark, sf_dir))


@query
def q_latest_by_city(spark, sf_dir):
    lat = _latest(spark, sf_dir)
    return lat.select("city", *serve.LATEST_FIELDS, time_text("event_time").alias("event_time"))


@query
def q_current_conditions(spark, sf_dir):
    return serve.current_conditions(_latest(spark, sf_dir))


@query
def q_temperature_series(spark, sf_dir):
    return serve.temperature_series(_clean(spark, sf_dir))


@query
def q_dual_series(spark, sf_dir):
    return serve.dual_series(_clean(spark, sf_dir))


@query
def q_wind_ranking(spark, sf_dir):
    return serve.wind_ranking(_latest(spark, sf_dir))


@query
def q_city_metric_matrix(spark, sf_dir):
    return serve.city_metric_matrix(_latest(spark, sf_dir))


@query
def q_window_series_city(spark, sf_dir):
    return serve.window_series_city(windows.window_aggregates(weather_view(spark, sf_dir)), "Paris")


@query
def q_agg_table_tail(spark, sf_dir):
    return serve.agg_table_tail(windows.window_aggregates(weather_view(spark, sf_dir)), 20)


@query
def q_distinct_cities(spark, sf_dir):
    return serve.distinct_cities(weather_view(spark, sf_dir))


@query
def q_lookup_default(spark, sf_dir):
    wv = weather_view(spark, sf_dir).select("event_id", "city", "weather_main")
    flags = lookups.dimension(spark, lookups.CITY_FLAGS, "city", "flag")
    icons = lookups.dimension(spark, lookups.WEATHER_ICONS, "weather_main", "icon")
    out = lookups.lookup_with_default(wv, flags, "city", "flag", lookups.DEFAULT_FLAG)
    out = lookups.lookup_with_default(out, icons, "weather_main", "icon", lookups.DEFAULT_ICON)
    return out.select("event_id", "city", "flag", "weather_main", "icon")


@query
def q_threshold_label(spark, sf_dir):
    wv = weather_view(spark, sf_dir)
    return wv.select("event_id", "temperature", threshold_label("temperature", 0.0).alias("label"))


@query
def q_poll_completeness(spark, sf_dir):
    return windows.poll_completeness(weather_view(spark, sf_dir), cycle="1 hour",
                                     expected=len(lookups.CITIES))


@query
def q_poll_completeness_minute(spark, sf_dir):
    """At the poll cycle of the source: one minute."""
    return windows.poll_completeness(weather_view(spark, sf_dir), expected=len(lookups.CITIES))


# ---- features and score statistics ------------------------------------------


@query
def q_delivery_by_cycle(spark, sf_dir):
    """Every minute of the span, those without any delivery included."""
    return windows.delivery_by_cycle(weather_view(spark, sf_dir), expected=len(lookups.CITIES))


@query
def q_feature_stats(spark, sf_dir):
    return features.feature_stats(_clean(spark, sf_dir))


@query
def q_standardize(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    stats = features.stats_dict(features.feature_stats(clean))
    return features.standardize(clean.select("event_id", *features.FEATURES), stats) \
        .select("event_id", *[f"z_{f}" for f in features.FEATURES])


@query
def q_feature_deviation(spark, sf_dir):
    return features.feature_deviation(_clean(spark, sf_dir))


@query
def q_feature_deviation_by_city(spark, sf_dir):
    return features.feature_deviation(_clean(spark, sf_dir), by="city")


@query
def q_histogram_by_city(spark, sf_dir):
    return scoring.histogram_by(_clean(spark, sf_dir), "temperature", "city")


def _pflag(spark, sf_dir):
    wv = weather_view(spark, sf_dir).select("event_id", "city", "temperature")
    return scoring.percentile_flag(wv, "temperature")


@query
def q_percentile_flag(spark, sf_dir):
    return _pflag(spark, sf_dir)


@query
def q_anomaly_rate_fixed(spark, sf_dir):
    return scoring.anomaly_rate(_pflag(spark, sf_dir))


# ---- isolation forest and anomaly tables -------------------------------------


def _model(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return clean, anom.fit_model(clean)


@query
def q_forest_fit(spark, sf_dir):
    _, m = _model(spark, sf_dir)
    return local_table(spark, m.forest.extra["nodes"], iforest.FOREST_NODE_SCHEMA)


@query
def q_forest_score(spark, sf_dir):
    scored, _ = anom.score_all(_clean(spark, sf_dir))
    return scored.select("event_id", "city", "anomaly_score", "anomaly_label")


@query
def q_forest_invariants(spark, sf_dir):
    """What every fitted tree obeys: psi rows at its root, as many in its leaves, children one level down."""
    clean = _clean(spark, sf_dir)
    zcols = features.FEATURES
    nodes, _ = iforest.fit_nodes(clean, zcols, ["event_id"])
    leaf = F.col("feature") < 0
    kids = nodes.select("tree_id", F.col("node_id").alias("kid"), F.col("n_rows").alias("kid_rows"), F.col("depth").alias("kid_depth"))
    split = nodes.where(~leaf).select("tree_id", "n_rows", "depth", F.explode(F.array("left", "right")).alias("kid"), "node_id") \
        .join(kids, ["tree_id", "kid"]).groupBy("tree_id", "node_id", "n_rows", "depth") \
        .agg(F.sum("kid_rows").alias("s"), F.max(F.col("kid_depth") - F.col("depth")).alias("d")) \
        .groupBy("tree_id").agg(F.count(F.when((F.col("s") != F.col("n_rows")) | (F.col("d") != 1), 1)).alias("bad_splits"))
    return nodes.groupBy("tree_id").agg(
        F.max(F.when(F.col("node_id") == 0, F.col("n_rows"))).cast("long").alias("root_rows"),
        F.sum(F.when(leaf, F.col("n_rows"))).alias("leaf_rows"),
        (F.max("depth") <= 8).alias("depth_ok")).join(split, "tree_id").select(
        "tree_id", "root_rows", "leaf_rows", "depth_ok", "bad_splits")


@query
def q_forest_flag_share(spark, sf_dir):
    """How many rows a fitted forest scores, and whether it flags those below the 5th percentile and no others."""
    scored, m = anom.score_all(_clean(spark, sf_dir))
    flagged = F.col("is_anomaly")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("anomaly_score").alias("n_scored"),
        (F.count(F.when(flagged, 1)) <= F.ceil(F.count(F.lit(1)) * 0.05)).alias("flags_bounded"),
        (F.max(F.when(flagged, F.col("anomaly_score"))) <= F.min(F.when(~flagged, F.col("anomaly_score")))).alias("flags_lowest"),
        ((F.min("anomaly_score") >= -1) & (F.max("anomaly_score") <= 0)).alias("in_range"))


@query
def q_forest_roundtrip(spark, sf_dir):
    """Every record scored with the literal forest after it went through the model store."""
    root = work_dir(spark, "model")
    model_store.save_model(spark, _fixed_model(spark), root, version=1)
    scored = anom.apply_model(_clean(spark, sf_dir), model_store.load_model(spark, root))
    return scored.select("event_id", "anomaly_score", "anomaly_label")


def _scored(spark, sf_dir):
    return anom.score_all(_clean(spark, sf_dir))[0]


@query
def q_detect_anomalies(spark, sf_dir):
    return anom.detect_anomalies(_clean(spark, sf_dir))


def _anomaly_tables(spark, scored):
    """Records and anomalies written as history tables (one batch per day)."""
    rec_path, an_path = work_dir(spark, "records"), work_dir(spark, "anomalies")
    history.write_batches(_day_batch(scored.drop("anomaly_label", "anomaly_score", "is_anomaly")), rec_path)
    history.write_batches(_day_batch(scored.where(F.col("is_anomaly"))), an_path)
    return history.read_history(spark, rec_path), history.read_history(spark, an_path, anomalies=True)


@query
def q_recent_anomalies(spark, sf_dir):
    _, an = _anomaly_tables(spark, _scored(spark, sf_dir))
    return anom.recent_anomalies(an, 20)


@query
def q_anomaly_rate(spark, sf_dir):
    rec, an = _anomaly_tables(spark, _scored(spark, sf_dir))
    return scoring.anomaly_rate(an, total=rec)


@query
def q_score_summary(spark, sf_dir):
    return anom.score_summary(_scored(spark, sf_dir))


@query
def q_anomaly_details(spark, sf_dir):
    return anom.anomaly_details(_scored(spark, sf_dir).where(F.col("is_anomaly")))


@query
def q_anomaly_histogram(spark, sf_dir):
    flagged = _scored(spark, sf_dir).where(F.col("is_anomaly"))
    return scoring.histogram_by(flagged, "anomaly_score", "city")


# A literal three-tree forest over the raw features (psi = 256), scored by the
# same executor code as a fitted one; the oracle unrolls it into CASE expressions.
FIXED_FOREST = [
    [(0, 0, 0, 10.0, 1, 4, 0, 256), (0, 1, 1, 50.0, 2, 3, 1, 100), (0, 2, -1, None, -1, -1, 2, 60),
     (0, 3, -1, None, -1, -1, 2, 40), (0, 4, -1, None, -1, -1, 1, 156)],
    [(1, 0, 2, 1000.0, 1, 2, 0, 256), (1, 1, -1, None, -1, -1, 1, 200), (1, 2, 3, 20.0, 3, 4, 1, 56),
     (1, 3, -1, None, -1, -1, 2, 50), (1, 4, -1, None, -1, -1, 2, 6)],
    [(2, 0, 4, 80.0, 1, 2, 0, 256), (2, 1, -1, None, -1, -1, 1, 210), (2, 2, -1, None, -1, -1, 1, 46)],
]


def _fixed_model(spark, threshold=-0.5):
    """The literal forest as a model: features as they are, a literal threshold."""
    nodes = iforest.literal_nodes(spark, FIXED_FOREST).collect()
    forest = iforest.Forest.from_nodes(nodes, [f"__z_{f}" for f in features.FEATURES], 256)
    forest.extra["nodes"] = [tuple(r) for r in nodes]
    stats = {f: {"feature": f, "n": 1, "median": 0.0, "mean": 0.0, "std_pop": 1.0} for f in features.FEATURES}
    return anom.Model(list(features.FEATURES), stats, forest, threshold, 1)


def _scored_fixed(spark, sf_dir):
    """The clean records with scores of the literal forest, cut at their exact 5th percentile."""
    clean, model = _clean(spark, sf_dir), _fixed_model(spark)
    raw = iforest.score(clean, model.forest, features.FEATURES)
    return anom.apply_model(clean, model, threshold=exact_quantile(raw, "anomaly_score_raw", scoring.CONTAMINATION))


@query
def q_detect_flagged_fixed(spark, sf_dir):
    flagged = _scored_fixed(spark, sf_dir).where(F.col("is_anomaly"))
    return flagged.select(*RECORD_FIELDS, "event_id", "anomaly_score", "anomaly_label")


@query
def q_score_summary_fixed(spark, sf_dir):
    return anom.score_summary(_scored_fixed(spark, sf_dir))


@query
def q_anomaly_details_fixed(spark, sf_dir):
    return anom.anomaly_details(_scored_fixed(spark, sf_dir).where(F.col("is_anomaly")))


@query
def q_anomaly_histogram_fixed(spark, sf_dir):
    return scoring.histogram_by(_scored_fixed(spark, sf_dir).where(F.col("is_anomaly")), "anomaly_score", "city")


@query
def q_recent_anomalies_fixed(spark, sf_dir):
    _, an = _anomaly_tables(spark, _scored_fixed(spark, sf_dir))
    return anom.recent_anomalies(an, 20)


@query
def q_anomaly_scan(spark, sf_dir):
    """The anomaly history as the dashboard reads it: records with their verdict, by time."""
    path = work_dir(spark, "anomalies")
    flagged = _scored_fixed(spark, sf_dir).where(F.col("is_anomaly"))
    history.write_batches(_day_batch(flagged), path)
    return history.anomaly_scan(spark, path).select(*RECORD_FIELDS, "event_id", "anomaly_label", "anomaly_score",
                                                    time_text("event_time").alias("event_time"))


@query
def q_anomaly_rate_history_fixed(spark, sf_dir):
    rec, an = _anomaly_tables(spark, _scored_fixed(spark, sf_dir))
    return scoring.anomaly_rate(an, total=rec)


@query
def q_anomaly_rate_capped_fixed(spark, sf_dir):
    rec, an = _anomaly_tables(spark, _scored_fixed(spark, sf_dir))
    return anom.capped_anomaly_rate(rec, an, cap_records=2000, cap_anomalies=500)


@query
def q_stream_anomalies_fixed(spark, sf_dir):
    """A stream of messages scored with the stored literal model, flagged rows appended by a stateless sink."""
    base = work_dir(spark, "stream-fixed")
    _messages(spark, sf_dir).write.parquet(f"{base}/in")
    obs = jobs.observation_stream(spark, fmt="parquet", path=f"{base}/in", keep=("offset",), with_corrupt=False)
    jobs.run_available_now(jobs.start_anomaly_sink(obs, _fixed_model(spark), f"{base}/out", f"{base}/ck",
                                                   trigger="available_now"))
    return spark.read.parquet(f"{base}/out").select(F.col("offset").alias("event_id"), "city", "anomaly_score", "anomaly_label")


@query
def q_forest_score_fixed(spark, sf_dir):
    nodes = iforest.literal_nodes(spark, FIXED_FOREST).collect()
    forest = iforest.Forest.from_nodes(nodes, features.FEATURES, 256)
    wv = weather_view(spark, sf_dir).select("event_id", *features.FEATURES)
    return iforest.score(wv, forest).select(
        "event_id", iforest.round4(F.col("anomaly_score_raw")).alias("anomaly_score"))


# ---- streaming -----------------------------------------------------------------


def _time_chunks(spark, sf_dir, n_chunks):
    """Kafka-shaped messages split into ``n_chunks`` consecutive time ranges.

    A table kept in time order has a range in a few of its file splits. The
    events are dealt evenly before they are encoded, so writing a chunk and
    parsing the files written take all cores, however the table lies.
    """
    events = read_table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    r = events.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    a, b = r["a"], r["b"]
    step = (b - a) // n_chunks + 1
    k = F.floor((at - F.lit(a)) / F.lit(step))
    width = max(4, spark.sparkContext.defaultParallelism)
    dealt = [events.where(k == i).repartition(width, "event_id", "ts") for i in range(n_chunks)]
    return [messages.encode_messages(weather_from_events(d), offset_col="event_id", num_partitions=4) for d in dealt]


def _stream_windows(spark, sf_dir, order, name):
    """Feed message chunks in ``order``, one availableNow run per chunk, to one checkpoint."""
    base = work_dir(spark, name)
    chunks = _time_chunks(spark, sf_dir, max(order) + 1)
    for i in order:
        chunks[i].write.mode("append").parquet(f"{base}/in")
        obs = jobs.observation_stream(spark, fmt="parquet", path=f"{base}/in")
        jobs.run_available_now(jobs.start_window_sink(obs, f"{base}/out", f"{base}/ck", trigger="available_now"))
    return history.agg_scan(spark, f"{base}/out")


@query
def q_stream_window_sink(spark, sf_dir):
    return _stream_windows(spark, sf_dir, [0], "stream-window")


@query
def q_stream_restart(spark, sf_dir):
    return _stream_windows(spark, sf_dir, [0, 1], "stream-restart")


@query
def q_stream_late_data(spark, sf_dir):
    return _stream_windows(spark, sf_dir, [2, 0, 4, 1, 3], "stream-late")


def _stream_records(spark, sf_dir, name, *, detect, n_chunks=1, order=None, **sink_args):
    base = work_dir(spark, name)
    sink = jobs.RecordSink(f"{base}/tables", detect=detect, **sink_args)
    chunks = _time_chunks(spark, sf_dir, n_chunks)
    for i in order or range(n_chunks):
        chunks[i].write.mode("append").parquet(f"{base}/in")
        obs = jobs.observation_stream(spark, fmt="parquet", path=f"{base}/in")
        jobs.run_available_now(jobs.start_record_sink(obs, sink, f"{base}/ck", trigger="available_now"))
    return sink


@query
def q_stream_clean_sink(spark, sf_dir):
    sink = _stream_records(spark, sf_dir, "stream-clean", detect=False)
    rec = history.read_history(spark, sink.records_path)
    return rec.select(*RECORD_FIELDS, F.col("offset").alias("event_id"))


@query
def q_stream_input_quality(spark, sf_dir):
    sink = _stream_records(spark, sf_dir, "stream-input", detect=False, n_chunks=5, order=[2, 0, 4, 1, 3])
    rows = history.read_history(spark, sink.input_path)
    return rows.select(F.col("batch_id").cast("long").alias("batch_id"), "rows_in", "null_time", "late_rows")


@query
def q_stream_anomalies(spark, sf_dir):
    sink = _stream_records(spark, sf_dir, "stream-anomalies", detect=True, n_chunks=5,
                           mode="score_then_retrain", retrain_every=2)
    an = history.read_history(spark, sink.anomalies_path)
    return an.select(*RECORD_FIELDS, F.col("offset").alias("event_id"), "anomaly_score", "anomaly_label",
                     F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def q_anomaly_rate_capped(spark, sf_dir):
    """The rate as a dashboard reading two capped files computes it (2,000 records, 500 anomalies)."""
    rec, an = _anomaly_tables(spark, _scored(spark, sf_dir))
    return anom.capped_anomaly_rate(rec.withColumn("batch_id", F.col("batch_id").cast("bigint")),
                                    an.withColumn("batch_id", F.col("batch_id").cast("bigint")),
                                    cap_records=2000, cap_anomalies=500)


@query
def q_detect_anomalies_fixed(spark, sf_dir):
    """Detection with the literal forest: score, exact 5th-percentile threshold, labels."""
    nodes = iforest.literal_nodes(spark, FIXED_FOREST).collect()
    forest = iforest.Forest.from_nodes(nodes, features.FEATURES, 256)
    scored = iforest.score(weather_view(spark, sf_dir).select("event_id", *features.FEATURES), forest)
    flagged = scoring.percentile_flag(scored, "anomaly_score_raw")
    return flagged.select("event_id", iforest.round4(F.col("anomaly_score_raw")).alias("anomaly_score"),
                          "anomaly_label", "is_anomaly")


@query
def q_city_metric_wide(spark, sf_dir):
    """The transposed matrix: one row per metric, one column per polled city."""
    return serve.city_metric_wide(_latest(spark, sf_dir), [c for c, _ in lookups.CITIES])


@query
def q_rejected_records(spark, sf_dir):
    """Rows the range rules reject, with the rules each one fails (comma-joined)."""
    rej = quality.rejected_records(weather_view(spark, sf_dir))
    return rej.select("event_id", "city", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query
def q_quarantined_payloads(spark, sf_dir):
    """Valid payloads mixed with each event's ``props`` JSON taken as a payload: only the
    latter (no ``main`` object) are quarantined."""
    wv = weather_from_events(read_table(spark, sf_dir, "events"), keep=["props"])
    raw = messages.encode_payloads(wv, passthrough=["event_id", "props"])
    bad = raw.select((-F.col("event_id") - 1).alias("event_id"), "props", "city", "country", "polled_at",
                     F.col("props").alias("payload"))
    raw = raw.unionByName(bad).drop("props")
    return messages.quarantined_payloads(raw).select("event_id", "payload", "reject_reason")


@query
def q_stream_quality_report(spark, sf_dir):
    """The quality row the streaming record sink writes for its (single) micro-batch."""
    sink = _stream_records(spark, sf_dir, "stream-quality", detect=False)
    return spark.read.parquet(sink.quality_path).drop("batch_id", "n_bad_field")
