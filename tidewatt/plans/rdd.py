"""RDD face of the queries (QRY-1c, QRY-2c, QRY-3c, AGG-5, UDF-1..5).

The JVM reads, parses and types the readings.  Python sees them as Arrow batches
and reduces each batch to one small state per group, with array operations; only
these (key, state) pairs become RDD elements.  From there on the RDD interface does
the work: states are merged by key inside each task and after the shuffle, ranked
and turned into percentiles, and nothing is collected on the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import tidewatt
from tidewatt.functions.exact import (
    EXTREME_PLACES,
    billionths_by_group,
    half_up,
    interpolated,
    mean_of_billionths,
)
from tidewatt.operators.profiles import PROBABILITIES
from tidewatt.operators.rankings import rankings
from tidewatt.sources.readings import for_entity, read_readings
from tidewatt.spec import ReadingSpec

# Functions travel to the executors with the tasks; nothing need be installed there.
cloudpickle.register_pickle_by_value(tidewatt)

# The whole number that stands for a period, in SQL.
PERIODS = {"year": "year(time)", "month": "year(time) * 100 + month(time)", "hour": "hour(time)"}
Readings = DataFrame | Sequence[DataFrame]


def from_text(
    spark: SparkSession, paths: Sequence[str], spec: ReadingSpec, policy: str = "strict_row"
) -> DataFrame:
    """Readings from clean CSV files (SRC-2), parsed by the same expressions as in the other faces."""
    return read_readings(spark, list(paths), "csv", spec, policy)


# --- running state of one group: [count, total, low, high] per metric --------


def _batch_states(batch: pa.RecordBatch, metrics: Sequence[str]) -> Iterator[tuple]:
    """((period, entity), state) of every group of a batch."""
    entity = batch.column(1).dictionary_encode()
    codes = entity.indices.fill_null(len(entity.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    names = [*entity.dictionary.to_pylist(), None]
    period = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    groups, group = np.unique(period * len(names) + codes, return_inverse=True)
    states = [[] for _ in groups]
    for k, name in enumerate(metrics, start=2):
        column = batch.column(k)
        there = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.to_numpy(zero_copy_only=False)[there].astype(np.float64)
        of = group[there]
        count = np.bincount(of, minlength=len(groups)).tolist()
        low, high = np.full(len(groups), math.inf), np.full(len(groups), -math.inf)
        np.minimum.at(low, of, values)
        np.maximum.at(high, of, values)
        totals = billionths_by_group(values, of, len(groups), name)
        for state, *measure in zip(states, count, totals, low.tolist(), high.tolist(), strict=True):
            state.append(measure)
    for code, state in zip(groups.tolist(), states, strict=True):
        yield (code // len(names), names[code % len(names)]), state


def _grouped(readings: Readings, spec: ReadingSpec, period: str) -> RDD:
    """States by (period, entity), of one or several inputs (SET-4); tasks combine before the shuffle."""
    parts = [readings] if isinstance(readings, DataFrame) else list(readings)
    metrics = spec.metric_names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_batch_states(batch, metrics))
            if rows:
                keys = [pa.array([key[0] for key, _ in rows], pa.int64()), pa.array([key[1] for key, _ in rows], pa.string())]
                fields = [
                    pa.array([[kind(measure[k]) for measure in state] for _, state in rows], pa.list_(of))
                    for k, (kind, of) in enumerate(((int, pa.int64()), (str, pa.string()), (float, pa.float64()), (float, pa.float64())))
                ]
                yield pa.RecordBatch.from_arrays([*keys, *fields], names=["period", "entity", "n", "total", "low", "high"])

    # Totals exceed 64 bits and so travel as text.
    schema = "period bigint, entity string, n array<bigint>, total array<string>, low array<double>, high array<double>"

    def pair(row) -> tuple:
        period_, entity, *fields = row
        return (period_, entity), [[n, int(total), low, high] for n, total, low, high in zip(*fields, strict=True)]

    def states(part: DataFrame) -> RDD:
        wanted = part.selectExpr(f"{PERIODS[period]} AS period", f"{spec.entity_group} AS entity", *metrics)
        return wanted.mapInArrow(run, schema).rdd.map(pair)

    found = [states(part) for part in parts]
    pairs = found[0] if len(found) == 1 else found[0].context.union(found)
    return pairs.reduceByKey(_merge)


def _merge(state: list, other: list) -> list:
    for mine, theirs in zip(state, other):
        mine[0] += theirs[0]
        mine[1] += theirs[1]
        mine[2] = min(mine[2], theirs[2])
        mine[3] = max(mine[3], theirs[3])
    return state


def _stats(state: list) -> list[float | None]:
    out = []
    for count, total, low, high in state:
        extremes = [half_up(v, EXTREME_PLACES) if count else None for v in (low, high)]
        out += [mean_of_billionths(total, count), *extremes]
    return out


def _means(state: list) -> list[float | None]:
    return [mean_of_billionths(total, count) for count, total, _, _ in state]


def _table(spark: SparkSession, rows: RDD, columns: list[tuple[str, T.DataType]]) -> DataFrame:
    schema = T.StructType([T.StructField(name, kind) for name, kind in columns])
    return spark.createDataFrame(rows, schema, verifySchema=False)


def _doubles(names: Sequence[str]) -> list[tuple[str, T.DataType]]:
    return [(name, T.DoubleType()) for name in names]


# --- queries ---------------------------------------------------------------


def yearly(spark: SparkSession, readings: Readings, spec: ReadingSpec) -> DataFrame:
    """Q1: mean, min and max per year and entity (SRT-2)."""
    rows = _grouped(readings, spec, "year").map(lambda group: (*group[0], *_stats(group[1])))
    measures = [f"{n}-{what}" for n in spec.metric_names for what in ("mean", "min", "max")]
    columns = [("year", T.IntegerType()), (spec.entity_name, T.StringType()), *_doubles(measures)]
    return _table(spark, rows, columns).orderBy(spec.entity_name, "year")


def month_rows(readings: Readings, spec: ReadingSpec, entity: str) -> RDD:
    """(month, mean, ...) of one entity (AGG-2, AGG-6); the filter reaches the scan."""
    parts = [readings] if isinstance(readings, DataFrame) else readings
    own = [for_entity(part, spec, entity) for part in parts]
    return _grouped(own, spec, "month").map(
        lambda group: ("{:04d}-{:02d}".format(*divmod(group[0][0], 100)), *_means(group[1]))
    )


def monthly(spark: SparkSession, months: RDD, spec: ReadingSpec) -> DataFrame:
    """Q2, all months: means of one entity, sorted."""
    columns = [("date", T.StringType()), *_doubles(spec.labels)]
    return _table(spark, months, columns).orderBy("date")


def monthly_top(spark: SparkSession, months: RDD, spec: ReadingSpec, k: int = 5) -> DataFrame:
    """Q2, rankings: each ranking keeps only its best ``k`` months while reducing (WIN-3, UDF-4)."""
    wanted = [
        (name, 1 + spec.labels.index(column), -1 if direction == "desc" else 1)
        for name, column, direction in rankings(spec)
    ]

    def candidates(row: tuple):
        for priority, (_, column, sign) in enumerate(wanted):
            if row[column] is not None:
                yield priority, (sign * row[column], row[0], row)

    def keep(best: list, more: list) -> list:
        return heapq.nsmallest(k, best + more)

    best = months.flatMap(candidates).aggregateByKey([], lambda b, row: keep(b, [row]), keep)
    rows = best.flatMap(
        lambda group: [
            (*row, wanted[group[0]][0], rank, group[0])
            for rank, (_, _, row) in enumerate(group[1], start=1)
        ]
    )
    columns = [
        ("date", T.StringType()),
        *_doubles(spec.labels),
        ("order_type", T.StringType()),
        ("rank", T.IntegerType()),
        ("order_priority", T.IntegerType()),
    ]
    return _table(spark, rows, columns).orderBy("order_priority", "rank").drop("order_priority")


def hour_rows(readings: Readings, spec: ReadingSpec) -> RDD:
    """(hour, entity, mean, ...) (AGG-3, AGG-6)."""
    return _grouped(readings, spec, "hour").map(lambda group: (*group[0], *_means(group[1])))


def hourly(spark: SparkSession, hours: RDD, spec: ReadingSpec) -> DataFrame:
    """Q3, profile: means per hour of day and entity, sorted."""
    columns = [("hour", T.IntegerType()), (spec.entity_name, T.StringType()), *_doubles(spec.labels)]
    return _table(spark, hours, columns).orderBy(spec.entity_name, "hour")


def hourly_stats(spark: SparkSession, hours: RDD, spec: ReadingSpec) -> DataFrame:
    """Q3, percentiles: a group is one metric's profile, at most 24 values (PRJ-8, UDF-5)."""
    labels = spec.labels

    def long(row: tuple):
        for label, value in zip(labels, row[2:]):
            if value is not None:
                yield (row[1], label), value

    def percentiles(values) -> list[float]:
        ordered = sorted(values)
        return [interpolated(ordered, p) for p in PROBABILITIES.values()]

    rows = hours.flatMap(long).groupByKey().map(lambda g: (*g[0], *percentiles(g[1])))
    columns = [
        (spec.entity_name, T.StringType()),
        ("data", T.StringType()),
        *_doubles(list(PROBABILITIES)),
    ]
    return _table(spark, rows, columns).orderBy(spec.entity_name, "data")
