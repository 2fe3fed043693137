"""Summary of measured run times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.exact import mean

TIMING_PLACES = 2


def recorded_runs(
    spark: SparkSession, seconds: Mapping[tuple[str, str], Sequence[float]]
) -> DataFrame:
    """A table of runs from measured times by (query, face), in run order (SRC-4)."""
    rows = [
        (query, api, run_no, value)
        for (query, api), values in seconds.items()
        for run_no, value in enumerate(values, start=1)
    ]
    return spark.createDataFrame(rows, "query string, api string, run_no int, seconds double")


def timing_summary(runs: DataFrame) -> DataFrame:
    """Number, mean and sample deviation of run times per query and face (AGG-8).

    ``runs`` has the columns query, api, run_no, seconds.  A single run has
    deviation 0.
    """
    return (
        runs.groupBy("query", "api")
        .agg(
            F.count("seconds").alias("runs"),
            mean("seconds", TIMING_PLACES).alias("mean_seconds"),
            F.round(F.coalesce(F.stddev_samp("seconds"), F.lit(0.0)), TIMING_PLACES).alias(
                "stdev_seconds"
            ),
        )
        .orderBy("query", "api")
    )


def run_times(runs: DataFrame) -> DataFrame:
    """The list of all run times, one row each in run order (AGG-8).

    Rows rather than one array per group: a group's array would have to fit into
    a single task.
    """
    return runs.select(
        "query", "api", "run_no", F.round("seconds", TIMING_PLACES).alias("seconds")
    ).orderBy("query", "api", "run_no")
