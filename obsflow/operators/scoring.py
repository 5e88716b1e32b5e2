"""Threshold labels, rates and histograms over a score (or any numeric) column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.numeric import exact_quantile
from obsflow.functions.text import fixed_1dp
from obsflow.sources.tables import local_table

# ---- Fixed values --------------------------------------------------------------
CONTAMINATION = 0.05
HIST_BINS = 20
# ------------------------------------------------------------------------------


def flag_below(df: DataFrame, col: str, threshold: float | None) -> DataFrame:
    """``anomaly_label`` -1 when ``col < threshold`` (strict), else 1; ``is_anomaly``."""
    below = F.col(col) < F.lit(threshold) if threshold is not None else F.lit(False)
    return df.withColumn("anomaly_label", F.when(below, F.lit(-1)).otherwise(F.lit(1)).cast("int")) \
             .withColumn("is_anomaly", F.col("anomaly_label") == -1)


def percentile_flag(df: DataFrame, col: str, q: float = CONTAMINATION) -> DataFrame:
    return flag_below(df, col, exact_quantile(df, col, q))


def rate_pct(num, den) -> F.Column:
    """``num * 100 / den``, 0 when ``den`` is 0."""
    return F.coalesce(F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double")), F.lit(0.0))


def anomaly_rate(flags: DataFrame, total: DataFrame | None = None, flag_col: str = "is_anomaly") -> DataFrame:
    """Totals and anomaly rate in percent (one row).

    With ``total`` given, the numerator is ``flags``' row count (already filtered
    anomalies) and the denominator ``total``'s row count, as two tables are read;
    otherwise both come from one flagged table in a single pass.
    """
    if total is None:
        agg = flags.agg(F.count(F.lit(1)).alias("n_total"),
                        F.coalesce(F.sum(F.when(F.col(flag_col), 1).otherwise(0)), F.lit(0))
                        .cast("bigint").alias("n_anomalies"))
    else:
        # two one-row counts combined by a union + max: no join of any kind is needed
        n_total = total.agg(F.count(F.lit(1)).alias("n_total"))
        n_anom = flags.agg(F.count(F.lit(1)).alias("n_anomalies"))
        agg = n_total.unionByName(n_anom, allowMissingColumns=True).agg(
            F.max("n_total").alias("n_total"), F.max("n_anomalies").alias("n_anomalies"))
        agg = agg.select(F.coalesce("n_total", F.lit(0)).cast("bigint").alias("n_total"),
                         F.coalesce("n_anomalies", F.lit(0)).cast("bigint").alias("n_anomalies"))
    rate = rate_pct(F.col("n_anomalies"), F.col("n_total"))
    return agg.select("n_total", "n_anomalies", rate.alias("anomaly_rate"),
                      F.concat(fixed_1dp(rate), F.lit("%")).alias("rate_text"))


def histogram_by(df: DataFrame, col: str, by: str = "city", bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram of ``col`` over its global [min, max], counted per ``by``.

    The maximum falls in the last bin. Bin edges come from one small aggregate.
    Only finite values are binned (NULL, NaN and infinities have no bin).
    """
    v = F.col(col).cast("double")
    finite = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    r = finite.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return local_table(df.sparkSession, [], f"{by} string, bin int, bin_start double, n bigint")
    df = finite
    if hi == lo:
        b = F.lit(1)
        start = F.lit(lo)
    else:
        width = (F.lit(hi) - F.lit(lo)) / F.lit(bins)
        b = F.least(F.floor((v - F.lit(lo)) / width) + 1, F.lit(bins)).cast("int")
        start = None
    g = df.groupBy(F.col(by), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if start is None:
        start = F.lit(lo) + (F.col("bin") - 1) * ((F.lit(hi) - F.lit(lo)) / F.lit(bins))
    return g.select(by, "bin", start.cast("double").alias("bin_start"), "n")
