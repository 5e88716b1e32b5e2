"""Declarative range rules and the data-quality report.

Rules are data: (name, SQL predicate). A row is kept when every predicate is
TRUE; NULL and NaN fail (three-valued logic, NaN sorts above every number).
The filter is a plain Catalyst predicate, so on a Parquet table the bounds are
pushed into the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: the physical range rules (bounds inclusive) --------------
DEFAULT_RULES = [
    ("temperature", "temperature BETWEEN -60 AND 60"),
    ("humidity", "humidity BETWEEN 0 AND 100"),
    ("pressure", "pressure BETWEEN 870 AND 1085"),
    ("wind_speed", "wind_speed >= 0"),
    ("visibility", "visibility >= 0"),
]
# ------------------------------------------------------------------------------


def _passes(rules) -> list[tuple[str, Column]]:
    return [(name, F.coalesce(F.expr(pred), F.lit(False))) for name, pred in rules]


def all_rules(rules=DEFAULT_RULES) -> Column:
    return reduce(lambda a, b: a & b, [F.expr(p) for _, p in rules])


def clean_records(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Rows that satisfy every rule."""
    return df.where(all_rules(rules))


def rejected_records(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Complement of ``clean_records``, with the names of the failed rules."""
    passes = _passes(rules)
    ok = reduce(lambda a, b: a & b, [c for _, c in passes])
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in passes]))
    return df.where(~ok).withColumn("failed_rules", failed)


def quality_report(df: DataFrame, rules=DEFAULT_RULES, *, by: list[str] | None = None,
                   time_col: str | None = "event_time",
                   malformed_col: str | None = None, bad_field_col: str | None = None) -> DataFrame:
    """One pass: rows, kept rows, rejects per rule, malformed rows, rows without time.

    Each rule is counted on its own (a row can fail several). All counters are
    sums, so the aggregate is partial on every partition before any shuffle.
    """
    passes = _passes(rules)
    kept = reduce(lambda a, b: a & b, [c for _, c in passes])

    def n_where(cond):  # 0, not NULL, on empty input
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    aggs = [F.count(F.lit(1)).alias("n_rows"), n_where(kept).alias("n_kept")]
    aggs += [n_where(~c).alias(f"n_bad_{n}") for n, c in passes]
    if malformed_col:
        aggs.append(n_where(F.coalesce(F.col(malformed_col), F.lit(False))).alias("n_malformed"))
    if bad_field_col:
        aggs.append(n_where(F.coalesce(F.col(bad_field_col), F.lit(False))).alias("n_bad_field"))
    if time_col:
        aggs.append(n_where(F.col(time_col).isNull()).alias("n_null_time"))
    g = df.groupBy(*by) if by else df
    return g.agg(*aggs)
