"""Statistics of readings by time grain and entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.exact import EXTREME_PLACES, mean
from tidewatt.functions.grains import grain
from tidewatt.spec import ReadingSpec


def _entity(spec: ReadingSpec) -> Column:
    return F.expr(spec.entity_group).alias(spec.entity_name)


def period_stats(readings: DataFrame, spec: ReadingSpec, by: str = "year") -> DataFrame:
    """Mean, minimum and maximum of every metric per period and entity (AGG-1, AGG-6, PRJ-3).

    One shuffle of one partial row per task and group, whatever the input size.
    """
    unit = grain(by)
    measures = []
    for name in spec.metric_names:
        measures += [
            mean(name).alias(f"{name}-mean"),
            F.round(F.min(name), EXTREME_PLACES).alias(f"{name}-min"),
            F.round(F.max(name), EXTREME_PLACES).alias(f"{name}-max"),
        ]
    grouped = readings.groupBy(F.expr(unit.key).alias("period"), _entity(spec)).agg(*measures)
    return grouped.select(
        F.expr(unit.display).alias(unit.name),
        *[F.col(f"`{c}`") for c in grouped.columns if c != "period"],
    )


def period_means(
    readings: DataFrame, spec: ReadingSpec, by: str, per_entity: bool = True
) -> DataFrame:
    """Mean of every metric per period, by entity or over all rows (AGG-2, AGG-3)."""
    unit = grain(by)
    entity = [_entity(spec)] if per_entity else []
    measures = [mean(m.name).alias(m.label) for m in spec.metrics]
    grouped = readings.groupBy(F.expr(unit.key).alias("period"), *entity).agg(*measures)
    return grouped.select(
        F.expr(unit.display).alias(unit.name),
        *[F.col(f"`{c}`") for c in grouped.columns if c != "period"],
    )


def row_counts(readings: DataFrame, spec: ReadingSpec, by: str = "year") -> DataFrame:
    """Readings per entity and period (AGG-7)."""
    unit = grain(by)
    grouped = readings.groupBy(_entity(spec), F.expr(unit.key).alias("period")).agg(
        F.count("*").alias("rows")
    )
    return grouped.select(spec.entity_name, F.expr(unit.display).alias(unit.name), "rows")
