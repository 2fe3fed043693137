"""SQL face of the queries (QRY-1b, QRY-2b, QRY-3b).

Every function takes the name of a view or table and returns what its statement
yields, so a stored or cached table can take the place of a view (SRC-7, PER-2).
Column names come from a validated ``ReadingSpec`` and are quoted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatt.functions.exact import EXTREME_PLACES, MEAN_PLACES, mean_sql
from tidewatt.functions.grains import grain
from tidewatt.operators.profiles import PROBABILITIES
from tidewatt.operators.rankings import rankings
from tidewatt.spec import ReadingSpec, quoted


def _means(spec: ReadingSpec) -> str:
    return ", ".join(f"{mean_sql(m.name)} AS {quoted(m.label)}" for m in spec.metrics)


def _labels(spec: ReadingSpec) -> str:
    return ", ".join(quoted(label) for label in spec.labels)


def yearly(spark: SparkSession, readings: str, spec: ReadingSpec) -> DataFrame:
    """Q1: mean, min and max per year and entity."""
    measures = ", ".join(
        f"{mean_sql(n)} AS `{n}-mean`, "
        f"round(min({n}), {EXTREME_PLACES}) AS `{n}-min`, "
        f"round(max({n}), {EXTREME_PLACES}) AS `{n}-max`"
        for n in spec.metric_names
    )
    return spark.sql(f"""
        SELECT {grain("year").key} AS year, {spec.entity_group} AS {spec.entity_name}, {measures}
        FROM {readings}
        GROUP BY {grain("year").key}, {spec.entity_group}
        ORDER BY {spec.entity_name}, year
    """)


def monthly(spark: SparkSession, readings: str, spec: ReadingSpec, entity: str) -> DataFrame:
    """Q2, all months: means of one entity, unsorted.

    A subquery rather than WITH: a cached view that holds a WITH is not found again
    by a statement that has one of its own.
    """
    unit = grain("month")
    return spark.sql(
        f"""
        SELECT {unit.display} AS date, {_labels(spec)}
        FROM (
            SELECT {unit.key} AS period, {_means(spec)}
            FROM {readings}
            WHERE {spec.entity_name} = :entity
            GROUP BY {unit.key}
        )
        """,
        args={"entity": entity},
    )


def monthly_top(spark: SparkSession, months: str, spec: ReadingSpec, k: int = 5) -> DataFrame:
    """Q2, rankings: the statement is built from metrics and directions (PRJ-7).

    ``stack`` repeats each month once per ranking, so one window serves them all.
    """
    choices = [
        f"'{name}', {i}, {'-' if direction == 'desc' else ''}{quoted(column)}"
        for i, (name, column, direction) in enumerate(rankings(spec), start=1)
    ]
    return spark.sql(
        f"""
        WITH repeated AS (
            SELECT date, {_labels(spec)}, order_type, order_priority, sort_value
            FROM {months}
            LATERAL VIEW stack({len(choices)}, {', '.join(choices)})
                AS order_type, order_priority, sort_value
            WHERE sort_value IS NOT NULL
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY order_type ORDER BY sort_value, date) AS rank
            FROM repeated
        )
        SELECT date, {_labels(spec)}, order_type, rank
        FROM ranked WHERE rank <= :k
        ORDER BY order_priority, rank
        """,
        args={"k": k},
    )


def hourly(spark: SparkSession, readings: str, spec: ReadingSpec) -> DataFrame:
    """Q3, profile: means per hour of day and entity, unsorted."""
    return spark.sql(f"""
        SELECT {grain("hour_of_day").key} AS hour, {spec.entity_group} AS {spec.entity_name}, {_means(spec)}
        FROM {readings}
        GROUP BY {grain("hour_of_day").key}, {spec.entity_group}
    """)


def hourly_stats(spark: SparkSession, profile: str, spec: ReadingSpec) -> DataFrame:
    """Q3, percentiles of the profile: one grouped ``percentile`` for all of them."""
    probs = ", ".join(str(p) for p in PROBABILITIES.values())
    outputs = ", ".join(
        f"round(p[{i}], {MEAN_PLACES}) AS {quoted(name)}" for i, name in enumerate(PROBABILITIES)
    )
    return spark.sql(f"""
        WITH long AS (
            SELECT * FROM {profile} UNPIVOT (value FOR data IN ({_labels(spec)}))
        ), grouped AS (
            SELECT {spec.entity_name}, data, percentile(value, array({probs})) AS p
            FROM long GROUP BY {spec.entity_name}, data
        )
        SELECT {spec.entity_name}, data, {outputs} FROM grouped
        ORDER BY {spec.entity_name}, data
    """)


def sorted_rows(spark: SparkSession, table: str, order: list[str]) -> DataFrame:
    """A table's rows in order (SRT-1)."""
    return spark.sql(f"SELECT * FROM {table} ORDER BY {', '.join(order)}")


def union_all(spark: SparkSession, views: list[str], spec: ReadingSpec) -> DataFrame:
    """All readings of several views (SET-3)."""
    columns = ", ".join(["time", spec.entity_name, *spec.metric_names])
    return spark.sql(" UNION ALL ".join(f"SELECT {columns} FROM {view}" for view in views))
