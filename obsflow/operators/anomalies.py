"""Anomaly detection over observation records, and its summary tables.

``detect_anomalies`` = guard (at least 5 rows) -> median imputation ->
standardisation -> forest fit -> score -> threshold at the 5th percentile of
the training scores (strict ``<``) -> label -> keep flagged rows, with every
input column. The model can also be fitted once (``fit_model``) and applied to
later data (``apply_model``): that is the "score, then retrain" policy of the
stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from obsflow.functions.numeric import exact_quantile
from obsflow.operators import features as feat
from obsflow.operators import forest as iforest
from obsflow.operators.scoring import CONTAMINATION, anomaly_rate, histogram_by  # noqa: F401
from obsflow.session import work_dir
from obsflow.sources.tables import local_table

# ---- Fixed values --------------------------------------------------------------
MIN_SAMPLES = 5
DETAIL_DIGITS = 1
RECENT_COLUMNS = ["timestamp", "city", "temperature", "humidity", "pressure", "wind_speed",
                  "weather_main", "anomaly_score"]
# ------------------------------------------------------------------------------
#: Columns that name a row, the first ones present: an event id, or the position in the topic.
KEY_COLS = [["event_id"], ["partition", "offset"], ["offset"]]


@dataclass
class Model:
    features: list[str]
    stats: dict[str, dict]
    forest: iforest.Forest
    threshold: float | None
    n_train: int
    version: int = 0


def _z(f: str) -> str:
    return f"__z_{f}"


def usable_features(stats: dict[str, dict]) -> list[str]:
    """Features with at least one non-NULL value (an all-NULL one cannot be imputed)."""
    return [f for f, s in stats.items() if s["median"] is not None]


def row_key(df: DataFrame) -> list[str]:
    """The columns that name a row of ``df`` (none: equal rows are numbered instead)."""
    return next((k for k in KEY_COLS if all(c in df.columns for c in k)), [])


def fit_and_score(df: DataFrame, *, features: list[str] = feat.FEATURES, n_trees: int = iforest.N_TREES,
                  max_samples: int = iforest.MAX_SAMPLES, seed: int = iforest.SEED,
                  contamination: float = CONTAMINATION, key_cols: list[str] | None = None,
                  version: int = 0, keep: bool = True) -> tuple[Model | None, DataFrame | None]:
    """Fit scaler + forest on ``df``, score it once, set the threshold from those scores.

    Returns the model and the scored rows: all columns (``keep``) or the score
    alone, written once to the shared folder, so that the threshold and later
    readers share one pass through Python and a lost executor costs no rescoring.
    """
    feats = feat.available(df, features)
    if not feats:
        return None, None
    n_rows = df.count()
    if n_rows < MIN_SAMPLES:
        return None, None
    stats = feat.stats_dict(feat.feature_stats(df, feats))
    feats = usable_features(stats)
    if not feats:
        return None, None
    z = feat.standardize(df, stats, prefix="__z_", features=feats)
    zcols = [_z(f) for f in feats]
    nodes, psi = iforest.fit_nodes(z, zcols, row_key(df) if key_cols is None else key_cols, n_trees=n_trees,
                                   max_samples=max_samples, seed=seed, n_rows=n_rows)
    node_rows = nodes.collect()  # bounded: trees * (2 psi - 1) rows
    nodes.unpersist()
    forest = iforest.Forest.from_nodes(node_rows, zcols, psi)
    forest.extra["nodes"] = [tuple(r) for r in node_rows]
    scored = iforest.score(z, forest).select(*(df.columns if keep else []), "anomaly_score_raw")
    path = work_dir(df.sparkSession, "scores")
    scored.write.parquet(path)
    scored = df.sparkSession.read.schema(scored.schema).parquet(path)
    thr = exact_quantile(scored, "anomaly_score_raw", contamination)
    return Model(feats, {f: stats[f] for f in feats}, forest, thr, n_rows, version), scored


def fit_model(df: DataFrame, **fit_args) -> Model | None:
    """Fit scaler + forest on ``df`` and set the threshold from its own scores."""
    return fit_and_score(df, keep=False, **fit_args)[0]


def _labelled(scored: DataFrame, columns: list[str], thr: float | None) -> DataFrame:
    below = (F.col("anomaly_score_raw") < F.lit(thr)) if thr is not None else F.lit(False)
    return scored.select(
        *columns,
        F.when(below, F.lit(-1)).otherwise(F.lit(1)).cast("int").alias("anomaly_label"),
        iforest.round4(F.col("anomaly_score_raw")).alias("anomaly_score"),
        below.alias("is_anomaly"),
    )


def apply_model(df: DataFrame, model: Model, *, threshold: float | None = None) -> DataFrame:
    """All input columns + anomaly_label (-1/1), anomaly_score (4 places), is_anomaly."""
    thr = model.threshold if threshold is None else threshold
    z = feat.standardize(df, model.stats, prefix="__z_", features=model.features)
    zcols = [_z(f) for f in model.features]
    return _labelled(iforest.score(z, model.forest, zcols), df.columns, thr)


def result_schema(df: DataFrame) -> StructType:
    return StructType(df.schema.fields + [StructField("anomaly_label", IntegerType(), True),
                                          StructField("anomaly_score", DoubleType(), True),
                                          StructField("is_anomaly", BooleanType(), True)])


def score_all(df: DataFrame, *, model: Model | None = None, **fit_args) -> tuple[DataFrame, Model | None]:
    """Every row scored and labelled (refit on ``df`` unless a model is given)."""
    if model is not None:
        return apply_model(df, model), model
    m, scored = fit_and_score(df, **fit_args)
    if m is None:
        return local_table(df.sparkSession, [], result_schema(df)), None
    return _labelled(scored, df.columns, m.threshold), m


def detect_anomalies(df: DataFrame, *, model: Model | None = None, **fit_args) -> DataFrame:
    """Flagged rows only (empty when fewer than 5 rows or no usable feature)."""
    scored, _ = score_all(df, model=model, **fit_args)
    return scored.where(F.col("is_anomaly"))


def score_summary(scored: DataFrame) -> DataFrame:
    """Min / max score among flagged rows, flagged and total counts, flagged share."""
    flagged = F.col("is_anomaly")
    return scored.agg(
        F.min(F.when(flagged, F.col("anomaly_score"))).alias("min_flagged_score"),
        F.max(F.when(flagged, F.col("anomaly_score"))).alias("max_flagged_score"),
        F.coalesce(F.sum(F.when(flagged, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n_flagged"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("flagged_share", F.coalesce(F.try_divide(F.col("n_flagged").cast("double"),
                                                          F.col("n_total").cast("double")), F.lit(0.0)))


def anomaly_details(anomalies: DataFrame, features: list[str] = feat.FEATURES) -> DataFrame:
    """City, score and each feature at one decimal (half to even), one row per anomaly."""
    k = float(10 ** DETAIL_DIGITS)
    cols = [(F.rint(F.col(f).cast("double") * k) / k).alias(f) for f in feat.available(anomalies, features)]
    keep = [c for c in ["event_id", "timestamp"] if c in anomalies.columns]
    return anomalies.select(*keep, F.coalesce(F.col("city"), F.lit("?")).alias("city"),
                            "anomaly_score", *cols)


def recent_anomalies(anomalies: DataFrame, n: int = 20, time_col: str = "event_time") -> DataFrame:
    """The ``n`` newest anomalies with the table's columns (a top-n, never a full sort)."""
    t = F.col(time_col) if time_col in anomalies.columns else F.try_to_timestamp(F.col("timestamp"))
    cols = [c for c in RECENT_COLUMNS if c in anomalies.columns]
    ties = [F.desc_nulls_last(c) for c in ("city", "event_id", "offset") if c in anomalies.columns]
    return anomalies.orderBy(F.desc_nulls_last(t), *ties).limit(n).select(*cols)


def capped_anomaly_rate(records_hist: DataFrame, anomalies_hist: DataFrame, *,
                        cap_records: int | None = None, cap_anomalies: int | None = None) -> DataFrame:
    """Anomaly rate over history tables, optionally over the newest N rows of each.

    With ``cap_records=2000, cap_anomalies=500`` this reproduces a dashboard
    that reads two capped files (its rate drifts towards 500 / 2000 once the
    record cap is reached); without caps both counts cover the same rows.
    """
    from obsflow.sources.history import history_last_n
    rec = history_last_n(records_hist, cap_records) if cap_records else records_hist
    an = history_last_n(anomalies_hist, cap_anomalies) if cap_anomalies else anomalies_hist
    return anomaly_rate(an, total=rec)
