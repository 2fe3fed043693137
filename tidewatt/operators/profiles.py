"""Percentiles of hour-of-day profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.exact import MEAN_PLACES
from tidewatt.spec import ReadingSpec, quoted

# Result columns and the probability of each.
PROBABILITIES = {"min": 0.0, "25-perc": 0.25, "50-perc": 0.5, "75-perc": 0.75, "max": 1.0}


def profile_percentiles(hourly: DataFrame, spec: ReadingSpec) -> DataFrame:
    """Exact interpolated percentiles per entity and metric (AGG-4, FN-8, FN-12, PRJ-8).

    The input is an hour-of-day profile, so a group never has more than 24
    values; every entity and metric is answered by the same grouped aggregate.
    The interpolated double is rounded as it stands: of the published values, some
    lie a hair below a rounding tie and are rounded down.
    """
    long = hourly.unpivot(
        [spec.entity_name], [quoted(label) for label in spec.labels], "data", "value"
    )
    probs = F.array(*[F.lit(p) for p in PROBABILITIES.values()])
    grouped = long.groupBy(spec.entity_name, "data").agg(F.percentile("value", probs).alias("p"))
    return grouped.select(
        spec.entity_name,
        "data",
        *[
            F.round(F.col("p")[i], MEAN_PLACES).alias(name)
            for i, name in enumerate(PROBABILITIES)
        ],
    )
