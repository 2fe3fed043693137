"""Batch analytics over time-stamped readings, written for PySpark.

A reading is a timestamp, an entity (a country, say) and one or more numeric
metrics.  The package ingests raw yearly CSV files, answers three families of
questions (yearly statistics, monthly means with rankings, hour-of-day profiles
with percentiles) through the DataFrame, SQL and RDD interfaces, and writes the
answers as CSV, keyed records or chart series.
"""

from tidewatt.spec import ELECTRICITY, Metric, ReadingSpec

__all__ = ["ELECTRICITY", "Metric", "ReadingSpec"]
