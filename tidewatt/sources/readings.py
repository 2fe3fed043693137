"""Readings from Parquet, CSV or any DataFrame, in one common shape."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.functions.parsing import finite, local_time, strict_double, strict_time
from tidewatt.spec import ReadingSpec, quoted

POLICIES = ("per_metric", "strict_row")


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, use one of {POLICIES}")
    return policy


def typed(
    df: DataFrame, spec: ReadingSpec, entity: str | None = None, keep: Sequence[Column] = ()
) -> DataFrame:
    """``time``, entity and metrics of a source, bad fields as NULL, then the ``keep`` columns.

    PRJ-1, PRJ-2, PRJ-5, PRJ-6, FN-5, FN-9.  ``entity`` gives the entity of a
    source that has no column for it.  A time with a zone becomes the local time
    of ``spec.zone``.  Parsing and the check for finite numbers are two projections
    so that no text is parsed twice.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def parsed(name: str, from_text: Callable[[Column], Column], kind: str) -> Column:
        column = F.col(quoted(name))
        if isinstance(types[name], T.TimestampType):
            return local_time(column, spec.zone).cast(kind)
        return from_text(column) if isinstance(types[name], T.StringType) else column.try_cast(kind)

    time = parsed(spec.time_col, strict_time, "timestamp_ntz").alias("time")
    who = F.lit(entity) if entity is not None else F.col(quoted(spec.entity_col)).cast("string")
    values = [parsed(m.source, strict_double, "double").alias(m.name) for m in spec.metrics]
    first = df.select(time, who.alias(spec.entity_name), *values, *keep)
    return first.withColumns({name: finite(F.col(name)) for name in spec.metric_names})


def as_readings(
    df: DataFrame, spec: ReadingSpec, policy: str = "per_metric", entity: str | None = None
) -> DataFrame:
    """Readings of ``df``; rows the policy refuses are left out (FLT-4, FLT-5).

    ``per_metric`` needs only a valid time and lets each metric skip its own
    NULLs; ``strict_row`` needs every metric as well.
    """
    check_policy(policy)
    sources = {"time": spec.time_col}
    if policy == "strict_row":
        sources |= {m.name: m.source for m in spec.metrics}
    types = {f.name: f.dataType for f in df.schema.fields}
    from_text = [name for name, source in sources.items() if isinstance(types[source], T.StringType)]
    shaped = parsed_once(typed(df, spec, entity), from_text)
    for name in sources:
        shaped = shaped.filter(F.col(name).isNotNull())
    return shaped


def parsed_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows, the columns ``names`` worked out before any filter on them.

    Spark would put the expressions behind a column into the filter as well, and text
    would be parsed for the filter and again for the row.  It puts none through a generator.
    """
    if not names:
        return df
    others = [name for name in df.columns if name not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def csv_text(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV files as text columns by position (SRC-2, FLT-3).

    Every field is read as text and judged by expressions: the reader's own
    malformed-row modes look only at the columns a query happens to need, so
    their answer changes with the query.  Extra fields are ignored, missing ones
    are NULL, quoted commas are handled, each file's header line is skipped.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", True).csv(paths)


def read_readings(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    spec: ReadingSpec,
    policy: str = "per_metric",
    entity: str | None = None,
) -> DataFrame:
    """Readings from Parquet or CSV files (SRC-1, SRC-2)."""
    if fmt == "csv":
        source = csv_text(spark, paths, spec.source_columns)
    elif fmt == "parquet":
        source = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    else:
        raise ValueError(f"unknown format {fmt!r}, use csv or parquet")
    return as_readings(source, spec, policy, entity)


def union_readings(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of several sources, duplicates kept, matched by column name (SET-1, SET-2)."""
    return reduce(DataFrame.unionByName, parts)


def for_entity(readings: DataFrame, spec: ReadingSpec, entity: str) -> DataFrame:
    """One entity's readings (FLT-1); the filter reaches the Parquet scan."""
    return readings.filter(F.col(spec.entity_name) == entity)


def register_readings(readings: DataFrame, name: str) -> str:
    """Make readings a temporary view for the SQL face (SRC-7)."""
    readings.createOrReplaceTempView(name)
    return name
