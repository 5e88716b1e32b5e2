"""Plan inspection: the text of ``df.explain(mode)``, for checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it (PushedFilters, ReadSchema, Exchanges...)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan (broadcasts not counted)."""
    text = plan_text(df, "simple")
    return sum(1 for line in text.splitlines() if "Exchange hashpartitioning" in line
               or "Exchange rangepartitioning" in line or "Exchange SinglePartition" in line
               or "Exchange RoundRobinPartitioning" in line)
