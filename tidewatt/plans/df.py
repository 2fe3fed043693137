"""DataFrame face of the queries (QRY-1a, QRY-2a, QRY-3a, UDF-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatt.operators.profiles import profile_percentiles
from tidewatt.operators.rankings import ranked_extremes
from tidewatt.operators.stats import period_means, period_stats
from tidewatt.sources.readings import for_entity
from tidewatt.spec import ReadingSpec


def yearly(readings: DataFrame, spec: ReadingSpec) -> DataFrame:
    """Q1: mean, min and max per year and entity (SRT-1)."""
    return period_stats(readings, spec, "year").orderBy(spec.entity_name, "year")


def monthly(readings: DataFrame, spec: ReadingSpec, entity: str) -> DataFrame:
    """Q2, all months: means of one entity, unsorted."""
    return period_means(for_entity(readings, spec, entity), spec, "month", False)


def monthly_top(months: DataFrame, spec: ReadingSpec, k: int = 5) -> DataFrame:
    """Q2, rankings: highest and lowest months of each metric."""
    return ranked_extremes(months, spec, "date", k)


def hourly(readings: DataFrame, spec: ReadingSpec) -> DataFrame:
    """Q3, profile: means per hour of day and entity, unsorted."""
    return period_means(readings, spec, "hour_of_day")


def hourly_stats(profile: DataFrame, spec: ReadingSpec) -> DataFrame:
    """Q3, percentiles of the profile."""
    return profile_percentiles(profile, spec).orderBy(spec.entity_name, "data")
