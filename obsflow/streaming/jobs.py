"""Streaming queries over the observation topic.

Two independent queries read the same source, each with its own checkpoint:

* window sink -- parse -> watermark 10 min -> 5-minute windows per city ->
  append to a file table; state is bounded by the watermark.
* record sink -- ``foreachBatch``: persist the batch once, write the quality
  row, the cleaned records and the anomalies to partition ``batch_id=N``
  (dynamic overwrite: a replayed batch replaces itself), optionally retrain.
  Nothing is collected; the model is the only thing read back to the driver
  and it is bounded by trees * (2 psi - 1) nodes.
"""

from __future__ import annotations

import logging
import time

from pyspark import StorageLevel
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obsflow.operators import anomalies as anom
from obsflow.operators import training
from obsflow.operators.quality import DEFAULT_RULES, clean_records, quality_report
from obsflow.operators.windows import WATERMARK, WINDOW, window_aggregates
from obsflow.sources import history, model_store, state_store
from obsflow.sources.messages import TOPIC, kafka_source, parse_messages
from obsflow.sources.tables import local_table

log = logging.getLogger(__name__)

# ---- Fixed values --------------------------------------------------------------
TRIGGER = "60 seconds"
# ------------------------------------------------------------------------------
ERROR_SCHEMA = "step string, error string, message string"
#: The record fields the window statistics read.
WINDOW_FIELDS = ["city", "timestamp", "temperature", "humidity", "pressure", "wind_speed", "clouds", "visibility"]


def observation_stream(spark: SparkSession, *, fmt: str = "kafka", path: str | None = None,
                       bootstrap: str | None = None, topic: str = TOPIC, options: dict | None = None,
                       keep: tuple[str, ...] = ("partition", "offset"), with_corrupt: bool = True,
                       fields: list[str] | None = None, **source_args) -> DataFrame:
    """Parsed observation stream (records + event_time [+ kept message columns]).

    ``source_args`` go to ``kafka_source`` (``min_partitions``, ``max_offsets_per_trigger``,
    ``starting_offsets``). ``fields`` limits the parse to those record fields.
    """
    msgs = kafka_source(spark, fmt=fmt, path=path, bootstrap=bootstrap, topic=topic, options=options,
                        **source_args)
    return parse_messages(msgs, keep=list(keep), with_corrupt=with_corrupt, fields=fields)


def _with_trigger(writer, trigger):
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_window_sink(obs: DataFrame, out_path: str, checkpoint: str, *, trigger=TRIGGER,
                      fmt: str = "json", duration: str = WINDOW, watermark: str = WATERMARK,
                      clean_first: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Closed windows appended to ``out_path`` (JSON lines by default)."""
    observed = obs.observe("input_quality", F.count(F.lit(1)).alias("rows"),
                           F.sum(F.when(F.col("event_time").isNull(), 1).otherwise(0)).alias("null_time"))
    aggs = window_aggregates(observed, duration=duration, watermark=watermark, clean_first=clean_first)
    w = (aggs.writeStream.outputMode("append").format(fmt)
         .option("path", out_path).option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return _with_trigger(w, trigger).start()


def is_storage_fault(exc: BaseException) -> bool:
    """Whether a failure comes from reading or writing files rather than from the model."""
    if isinstance(exc, OSError):
        return True
    if isinstance(exc, PythonException):  # raised by a Python worker: the model's own code
        return False
    text = str(exc)
    return any(k in text for k in ("java.io.", "java.nio.file.", "org.apache.hadoop.fs.", "org.apache.hadoop.hdfs.",
                                   "FAILED_READ_FILE", "TASK_WRITE_FAILED")) and "PythonException" not in text


class RecordSink:
    """``foreachBatch`` body: quality row, cleaned records, anomalies, model upkeep.

    ``mode="score_then_retrain"``: score with the newest committed model (the
    first batch fits one), refit on all history every ``retrain_every`` batches,
    committed as version = batch id. The refit reads the training state, into
    which every batch is merged (``operators.training``), never the history; or
    the newest ``train_rows`` rows where the caller asks for that bound.
    ``mode="refit_batch"``: fit on each batch and score it with that fit.
    ``detect=False`` skips the model entirely.

    Every batch leaves one row in ``input``: rows read, rows without time, and
    rows that the window query drops as late, whose window of ``duration`` ends
    at or before the newest time of the batches before it less ``watermark``.

    Failures: scoring runs to its end into a staging table before its rows are
    published, so a model that fails on an executor, like one that fails on the
    driver, leaves the records, writes a row to ``errors`` and does not fail the
    batch. A read or write that fails does fail it, so it is replayed.
    """

    def __init__(self, root: str, *, rules=DEFAULT_RULES, detect: bool = True,
                 mode: str = "score_then_retrain", retrain_every: int = 2,
                 train_rows: int | None = None, fit_args: dict | None = None,
                 duration: str = WINDOW, watermark: str = WATERMARK):
        self.root = root.rstrip("/")
        self.rules = rules
        self.detect = detect
        self.mode = mode
        self.retrain_every = max(1, retrain_every)
        self.train_rows = train_rows
        self.fit_args = fit_args or {}
        self.duration = duration
        self.watermark = watermark
        self._seen = None  # (batch id, newest time before it, newest time with it)
        self._model = None  # the model in use, reloaded only when another version is needed

    @property
    def records_path(self):
        return f"{self.root}/records"

    @property
    def anomalies_path(self):
        return f"{self.root}/anomalies"

    @property
    def quality_path(self):
        return f"{self.root}/quality"

    @property
    def input_path(self):
        return f"{self.root}/input"

    @property
    def errors_path(self):
        return f"{self.root}/errors"

    @property
    def state_path(self):
        return f"{self.root}/training"

    @property
    def model_path(self):
        return f"{self.root}/model"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            flags = [c for c in ("is_malformed", "has_bad_field") if c in batch.columns]
            malformed, bad_field = (flags + [None, None])[:2]
            history.write_batch(quality_report(batch, self.rules, malformed_col=malformed, bad_field_col=bad_field),
                                self.quality_path, batch_id)
            self._input_quality(batch, batch_id)
            clean = clean_records(batch.drop(*flags), self.rules)
            history.write_batch(clean, self.records_path, batch_id)
            if self.detect:
                self._anomalies(batch.sparkSession, clean, batch_id)
        finally:
            batch.unpersist()

    def _newest_before(self, spark: SparkSession, batch_id: int):
        """The newest event time of the batches before this one; read from ``input`` only after a restart."""
        if self._seen is not None:
            last, before, until = self._seen
            if last < batch_id:
                return until
            if last == batch_id:
                return before
        rows = history.read_history(spark, self.input_path)
        if "seen_until" not in rows.columns:
            return None
        return rows.where(F.col("batch_id") < F.lit(batch_id)).agg(F.max("seen_until").alias("t")).first()["t"]

    def _input_quality(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._newest_before(spark, batch_id)
        mark = F.date_trunc("MILLISECOND", F.lit(before).cast("timestamp")) - F.expr(f"INTERVAL {self.watermark}")
        t = F.col("event_time")
        at, step = F.unix_micros(t), F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + INTERVAL {self.duration})")
        w_end = F.timestamp_micros(at - F.pmod(at, step) + step)
        row = batch.agg(F.count(F.lit(1)).alias("rows_in"), F.count(F.when(t.isNull(), 1)).alias("null_time"),
                        F.count(F.when(w_end <= mark, 1)).alias("late_rows"), F.max(t).alias("newest")).first()
        until = max((x for x in (before, row["newest"]) if x is not None), default=None)
        out = local_table(
            spark, [(row["rows_in"], row["null_time"], row["late_rows"], before, until)],
            "rows_in long, null_time long, late_rows long, seen_before timestamp, seen_until timestamp")
        history.write_batch(out, self.input_path, batch_id)
        self._seen = (batch_id, before, until)

    def _anomalies(self, spark: SparkSession, clean: DataFrame, batch_id: int) -> None:
        scored = self._guarded(spark, batch_id, "scoring", lambda: self._staged(spark, clean, batch_id))
        if scored is not None:
            history.write_batch(scored, self.anomalies_path, batch_id)
        if self.mode == "refit_batch":
            return
        state = None
        if self.train_rows is None:
            state = self._guarded(spark, batch_id, "training state", lambda: self._merged(spark, batch_id))
        if scored is not None and batch_id > 0 and batch_id % self.retrain_every == 0:
            fresh = self._guarded(spark, batch_id, "retraining", lambda: self._retrained(spark, batch_id, state))
            if fresh is not None:
                model_store.save_model(spark, fresh, self.model_path, batch_id)
                self._model = fresh

    def _guarded(self, spark: SparkSession, batch_id: int, what: str, step):
        """The step's result, or None with an error row written. Steps run their own jobs, so what
        fails on an executor fails in here; what cannot be written or read fails the batch."""
        try:
            return step()
        except Exception as exc:  # noqa: BLE001 - keep the batch even when the model fails
            if is_storage_fault(exc):
                raise
            log.error("batch %s: %s failed: %s", batch_id, what, exc, exc_info=True)
            history.write_batch(local_table(spark, [(what, type(exc).__name__, str(exc)[:2000])], ERROR_SCHEMA),
                                f"{self.errors_path}/{what.replace(' ', '_')}", batch_id)
            return None

    def _staged(self, spark: SparkSession, clean: DataFrame, batch_id: int) -> DataFrame | None:
        """The batch's anomalies, computed to the end and written to a staging table: the first phase.

        Publishing them reads files only, so a model that fails does so here
        and a publication that fails is storage. A replay stages anew.
        """
        scored = self._scored(spark, clean, batch_id)
        if scored is None:
            return None
        flagged = scored.where(F.col("is_anomaly"))
        path = f"{self.root}/staging/anomalies"
        flagged.write.mode("overwrite").parquet(path)
        return spark.read.schema(flagged.schema).parquet(path)

    def _scored(self, spark: SparkSession, clean: DataFrame, batch_id: int) -> DataFrame | None:
        if self.mode == "refit_batch":
            return anom.score_all(clean, **self.fit_args)[0]
        model = self._model_for(spark, batch_id)
        if model is not None:
            return anom.apply_model(clean, model)
        scored, model = anom.score_all(clean, version=batch_id, **self.fit_args)
        if model is None:
            return None
        model_store.save_model(spark, model, self.model_path, batch_id)
        self._model = model
        return scored

    def _args(self, *names: str) -> dict:
        return {k: v for k, v in self.fit_args.items() if k in names}

    def _merged(self, spark: SparkSession, batch_id: int) -> training.TrainingState:
        """The training state up to this batch: the state before it and the batches since, usually this one alone."""
        state, upto = state_store.load_state(spark, self.state_path, before=batch_id)
        since = history.batches_after(spark, self.records_path, upto, batch_id)
        if since is None:
            rows = history.read_history(spark, self.records_path).where(F.col("batch_id") <= F.lit(batch_id))
        else:
            rows = history.read_batches(spark, self.records_path, since)
        state = training.merged(state, rows.drop("batch_id", "row_hash"), salt=batch_id,
                                **self._args("features", "key_cols", "n_trees", "max_samples", "seed"))
        return state_store.save_state(spark, state, self.state_path, batch_id)

    def _retrained(self, spark: SparkSession, batch_id: int, state: training.TrainingState | None = None):
        if self.train_rows is not None:
            ids = history.newest_batches(spark, self.records_path, self.train_rows)
            if ids is None or any(i > batch_id for i in ids):  # an old batch is replayed
                hist = history.read_history(spark, self.records_path).where(F.col("batch_id") <= F.lit(batch_id))
                hist = history.history_last_n(hist, self.train_rows)
            else:
                hist = history.last_n(spark, self.records_path, self.train_rows)
            return anom.fit_model(hist.drop("batch_id", "row_hash"), version=batch_id, **self.fit_args)
        return training.fit_state(state or self._merged(spark, batch_id), version=batch_id,
                                  **self._args("n_trees", "max_samples", "seed", "contamination"))

    def _model_for(self, spark: SparkSession, batch_id: int):
        """The newest version committed before this batch, so a replayed batch is scored
        with the same model as the first time; the very first batch fits its own."""
        v = model_store.latest_version(spark, self.model_path, before=batch_id)
        if v is None:
            v = batch_id if model_store.latest_version(spark, self.model_path, before=batch_id + 1) == batch_id \
                else None
            if v is None:
                return None
        if self._model is None or self._model.version != v:
            self._model = model_store.load_model(spark, self.model_path, v)
        return self._model


def start_record_sink(obs: DataFrame, sink: RecordSink, checkpoint: str, *, trigger=TRIGGER,
                      query_name: str | None = None) -> StreamingQuery:
    w = obs.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _with_trigger(w, trigger).start()


def start_consumer(spark: SparkSession, root: str, *, fmt: str = "kafka", path: str | None = None,
                   bootstrap: str | None = None, topic: str = TOPIC, trigger=TRIGGER,
                   sink_options: dict | None = None, **source_args) -> list[StreamingQuery]:
    """Both queries over one topic, each reading the source with its own offsets."""
    root = root.rstrip("/")
    obs_a = observation_stream(spark, fmt=fmt, path=path, bootstrap=bootstrap, topic=topic, keep=(),
                               with_corrupt=False, fields=WINDOW_FIELDS, **source_args)
    obs_b = observation_stream(spark, fmt=fmt, path=path, bootstrap=bootstrap, topic=topic, **source_args)
    q1 = start_window_sink(obs_a, f"{root}/aggregations", f"{root}/checkpoints/agg", trigger=trigger)
    q2 = start_record_sink(obs_b, RecordSink(root, **(sink_options or {})), f"{root}/checkpoints/raw",
                           trigger=trigger)
    return [q1, q2]


def await_any(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None,
              poll: float = 0.5) -> bool:
    """Wait until one of ``queries`` stops; then stop the others and re-raise a failure.

    Other queries of the session do not matter. Returns False, with all queries
    left running, when ``timeout`` seconds pass first.
    """
    end = None if timeout is None else time.monotonic() + timeout
    while all(q.isActive for q in queries):
        if end is not None and time.monotonic() >= end:
            return False
        time.sleep(poll if end is None else max(0.0, min(poll, end - time.monotonic())))
    errors = [q.exception() for q in queries if not q.isActive and q.exception() is not None]
    for q in queries:
        if q.isActive:
            q.stop()
    if errors:
        raise RuntimeError(f"streaming query failed: {errors[0]}")
    return True


def run_available_now(query: StreamingQuery) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def start_anomaly_sink(obs: DataFrame, model: "anom.Model", out_path: str, checkpoint: str, *,
                       trigger=TRIGGER, fmt: str = "parquet", rules=DEFAULT_RULES,
                       flagged_only: bool = True) -> StreamingQuery:
    """Score a stream with a fixed (committed) model: stateless, no ``foreachBatch``.

    The forest travels as a broadcast and each micro-batch is scored by
    a scalar Arrow UDF on the executors; the threshold is the model's own.
    """
    scored = anom.apply_model(clean_records(obs, rules), model)
    if flagged_only:
        scored = scored.where(F.col("is_anomaly"))
    w = (scored.writeStream.outputMode("append").format(fmt)
         .option("path", out_path).option("checkpointLocation", checkpoint))
    return _with_trigger(w, trigger).start()
