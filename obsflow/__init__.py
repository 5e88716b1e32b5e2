"""obsflow: Spark-native analytics for streams of city sensor observations.

Everything here is plain DataFrame / Structured Streaming code: functions take
DataFrames and return DataFrames, so Catalyst plans each served table.
"""

from obsflow.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
