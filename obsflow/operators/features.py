"""Per-feature statistics: median (imputation), mean and population std (scaling),
mean absolute deviation from the median.

NaN and infinities count as missing. Medians are exact and found by histogram
narrowing (``functions.numeric``); the other statistics are one partial
aggregation pass over the values as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.numeric import SNAP, exact_quantiles, finite_or_null, quantiles_by, rounded_avg

# ---- Fixed values: model features --------------------------------------------
FEATURES = ["temperature", "humidity", "pressure", "wind_speed", "clouds"]
# ------------------------------------------------------------------------------


def available(df: DataFrame, features=FEATURES) -> list[str]:
    return [f for f in features if f in df.columns]


def medians(df: DataFrame, features=FEATURES) -> dict[str, float | None]:
    """Exact median of the finite values of each feature (None without any), free of interpolation noise."""
    src = df.select(*[finite_or_null(f).alias(f) for f in features])
    return {f: None if m is None else round(m, SNAP) for f, m in exact_quantiles(src, list(features), 0.5).items()}


def medians_by(df: DataFrame, by: list[str], features=FEATURES) -> DataFrame:
    """``by`` and ``med_<feature>``: exact medians per group."""
    src = df.select(*by, *[finite_or_null(f).alias(f"med_{f}") for f in features])
    out = quantiles_by(src, by, [f"med_{f}" for f in features], 0.5)
    return out.select(*by, *[F.round(f"med_{f}", SNAP).alias(f"med_{f}") for f in features])


def non_finite_counts(df: DataFrame, features=FEATURES) -> dict[str, int]:
    """How many NaN or infinite values each feature holds (they count as missing)."""
    aggs = [F.count(F.when(F.col(f).isNotNull() & finite_or_null(f).isNull(), 1)).alias(f) for f in features]
    return df.agg(*aggs).first().asDict()


def _long(row_df: DataFrame, features, fields: dict[str, str], by=None) -> DataFrame:
    items = [F.struct(F.lit(f).alias("feature"),
                      *[F.col(tmpl.format(f=f)).alias(name) for name, tmpl in fields.items()])
             for f in features]
    return row_df.select(*(by or []), F.explode(F.array(*items)).alias("__s")).select(*(by or []), "__s.*")


def feature_stats(df: DataFrame, features=FEATURES) -> DataFrame:
    """feature, n (finite values), median, mean and std_pop of the median-imputed column.

    A constant feature has std_pop 0 (scaling then divides by 1).
    """
    features = available(df, features)
    med = medians(df, features)
    aggs = []
    for f in features:
        m = F.lit(med[f]).cast("double")
        imputed = F.coalesce(finite_or_null(f), m)
        aggs += [F.count(finite_or_null(f)).alias(f"n_{f}"), m.alias(f"med_{f}"),
                 rounded_avg(imputed, 6).alias(f"mean_{f}"),
                 F.round(F.stddev_pop(imputed), 6).alias(f"std_{f}")]
    return _long(df.agg(*aggs), features,
                 {"n": "n_{f}", "median": "med_{f}", "mean": "mean_{f}", "std_pop": "std_{f}"})


def stats_dict(stats: DataFrame) -> dict[str, dict]:
    """Collect a feature-stats table (one row per feature: bounded) for scaling."""
    return {r["feature"]: r.asDict() for r in stats.collect()}


def standardize(df: DataFrame, stats: dict[str, dict], prefix: str = "z_",
                features=None) -> DataFrame:
    """``(coalesce(x, median) - mean) / std`` per feature; std 0 -> 1.

    Features whose column is entirely NULL (median NULL) are left out.
    """
    feats = [f for f in (features or stats) if stats[f]["median"] is not None]
    cols = []
    for f in feats:
        s = stats[f]
        sd = s["std_pop"] if s["std_pop"] not in (None, 0.0) else 1.0
        cols.append(((F.coalesce(finite_or_null(f), F.lit(s["median"])) - F.lit(s["mean"]))
                     / F.lit(sd)).alias(prefix + f))
    return df.select("*", *cols)


def feature_deviation(df: DataFrame, features=FEATURES, by: str | None = None) -> DataFrame:
    """Mean absolute deviation from the median, per feature (and per ``by`` group), descending.

    ``by=None`` uses one global median per feature; ``by="city"`` each city's own.
    """
    features = available(df, features)
    if by is None:
        med = medians(df, features)
        grp = df.select(*[F.lit(med[f]).cast("double").alias(f"med_{f}") for f in features], *features)
    else:
        # the medians are one row per group; adaptive execution picks the join by their measured size
        per = medians_by(df, [by], features).withColumnRenamed(by, "__by")
        grp = df.select(by, *features).join(per, F.col(by).eqNullSafe(F.col("__by"))).drop("__by").groupBy(by)
    aggs = [rounded_avg(F.abs(finite_or_null(f) - F.col(f"med_{f}")), 6).alias(f"mad_{f}") for f in features]
    out = _long(grp.agg(*aggs), features, {"mad": "mad_{f}"}, [by] if by else None)
    return out.orderBy(*([by] if by else []), F.desc("mad"))
