"""Chart series: one row per point in time, one column per drawn entity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.spec import ReadingSpec, quoted


def time_axis(unit: str) -> Column:
    """The time a result's period stands for: a date, or an ``HH:mm:ss`` text for hours."""
    axes = {
        "year": F.make_date(F.col("year"), F.lit(1), F.lit(1)),
        "date": F.to_date(F.concat(F.col("date"), F.lit("-01"))),
        "hour": F.format_string("%02d:00:00", F.col("hour")),
    }
    if unit not in axes:
        raise ValueError(f"no time axis for {unit!r}, use one of {sorted(axes)}")
    return axes[unit]


def split_series(
    result: DataFrame, spec: ReadingSpec, unit: str, value: str, labels: Mapping[str, str]
) -> DataFrame:
    """One column per entity in ``labels``, named by its label (SER-1, SER-2, SER-5, SER-6).

    The entities to draw are given, so the pivot needs no extra job to find them.
    A cell has one row, so ``max`` takes it, and the order of ``result`` need not be kept.
    """
    points = result.select(
        time_axis(unit).alias("time"),
        F.col(spec.entity_name).alias("split"),
        F.col(quoted(value)).alias("value"),
    )
    wide = points.groupBy("time").pivot("split", list(labels)).agg(F.max("value"))
    renamed = [F.col(quoted(entity)).alias(label) for entity, label in labels.items()]
    return wide.select("time", *renamed).orderBy("time")


def single_series(result: DataFrame, unit: str, value: str, label: str) -> DataFrame:
    """Time and one value column (SER-3, SER-4)."""
    return result.select(
        time_axis(unit).alias("time"), F.col(quoted(value)).alias(label)
    ).orderBy("time")
