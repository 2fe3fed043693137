"""Highest and lowest periods of every metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatt.spec import ReadingSpec, quoted

# Fixed value: direction order within a metric.
DIRECTIONS = ("desc", "asc")


def rankings(spec: ReadingSpec) -> list[tuple[str, str, str]]:
    """(name, ranked column, direction) of every ranking, in result order."""
    return [(f"{m.name}_{d}", m.label, d) for m in spec.metrics for d in DIRECTIONS]


def ranking_order(spec: ReadingSpec) -> Column:
    """Place of a row's ranking in the result order, for stored rankings (SRT-3, FN-7)."""
    names = [name for name, _, _ in rankings(spec)]
    pairs = [F.lit(c) for i, name in enumerate(names) for c in (name, i)]
    return F.create_map(*pairs)[F.col("order_type")]


def ranked_extremes(
    df: DataFrame, spec: ReadingSpec, key: str, k: int = 5, within: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows of each metric.

    WIN-1, WIN-2, TOP-1, FLT-2, SRT-3, FN-7, PRJ-8.  All rankings come from one
    window: every row is repeated once per metric and direction with its sort
    value (negated for descending), and Spark keeps only ``k`` rows per ranking
    in each task before the shuffle.  Ties go to the smaller ``key``; a NULL mean
    has no rank.  ``within`` ranks inside each of those columns' groups.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    choices = []
    for priority, (name, column, direction) in enumerate(rankings(spec), start=1):
        value = F.col(quoted(column))
        choices.append(
            F.struct(
                F.lit(name).alias("order_type"),
                F.lit(priority).alias("order_priority"),
                (-value if direction == "desc" else value).alias("sort_value"),
            )
        )
    columns = [F.col(quoted(c)) for c in df.columns]
    repeated = (
        df.select(*columns, F.explode(F.array(*choices)).alias("choice"))
        .select(*columns, "choice.*")
        .filter(F.col("sort_value").isNotNull())
    )
    window = W.partitionBy(*within, "order_type").orderBy("sort_value", key)
    return (
        repeated.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .orderBy(*within, "order_priority", "rank")
        .select(*columns, "order_type", "rank")
    )
