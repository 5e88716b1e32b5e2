"""Temp views over the served tables, so the same results can be queried in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsflow.operators import quality, serve, windows


def register_views(spark: SparkSession, records: DataFrame, prefix: str = "") -> list[str]:
    """Register ``records``, ``clean_records``, ``window_aggregates``, ``latest_by_city``.

    The views are lazy plans: a SQL query over them is optimised together with
    the DataFrame code behind them (filters still reach the scan).
    """
    clean = quality.clean_records(records)
    views = {
        "records": records,
        "clean_records": clean,
        "window_aggregates": windows.window_aggregates(records),
        "latest_by_city": serve.latest_by_city(clean),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
