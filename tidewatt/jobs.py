"""Entry points: one query, or everything from raw files to chart series."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidewatt.ingest import Columns, Dataset, Expected, check_expected, ingest, ingest_report, read_raw, write_text
from tidewatt.operators.profiles import PROBABILITIES
from tidewatt.operators.rankings import ranking_order
from tidewatt.operators.series import single_series, split_series
from tidewatt.plans import FACES, QUERIES, df, rdd, sql
from tidewatt.sinks.records import (
    RecordLayout,
    hash_records,
    percentile_layout,
    ranking_layout,
    yearly_layout,
)
from tidewatt.sinks.results import check_run_id, new_run_id, write_result, write_single_csv
from tidewatt.sinks.store import RecordStore
from tidewatt.sources.files import read_result
from tidewatt.sources.readings import as_readings, register_readings
from tidewatt.spec import ReadingSpec


# The column every row of an output has; an entity may be missing.
REQUIRED = {"result": "year", "all": "date", "top": "rank", "hourly": "hour", "stats": "data"}


def check_choice(query: str, face: str, entity: str | None) -> None:
    if query not in QUERIES:
        raise ValueError(f"unknown query {query!r}, use one of {QUERIES}")
    if face not in FACES:
        raise ValueError(f"unknown face {face!r}, use one of {tuple(FACES)}")
    if query == "q2" and entity is None:
        raise ValueError("q2 ranks the months of one entity; give its name")


@dataclass(frozen=True)
class Tables:
    """What a query yields, not yet computed.

    ``shared`` is the aggregate that several outputs start from: a DataFrame, or
    the name of a view in the SQL face, whose ``views`` go when the outputs are done.
    """

    outputs: dict[str, DataFrame]
    shared: DataFrame | str | None = None
    views: tuple[str, ...] = ()


def run_query(
    spark: SparkSession,
    query: str,
    face: str,
    readings: DataFrame | Sequence[DataFrame],
    spec: ReadingSpec,
    entity: str | None = None,
    k: int = 5,
    view: str | None = None,
) -> Tables:
    """The output tables of a query (JOB-2).

    ``q1`` yields ``result``; ``q2`` (which needs ``entity``) ``all`` and ``top``;
    ``q3`` ``hourly`` and ``stats``.  The RDD face also takes several inputs.
    The SQL face registers views whose names start with ``view``, or with a name of
    their own, so that no later call replaces them.
    """
    check_choice(query, face, entity)
    if face == "rdd":
        return _run_rdd(spark, query, readings, spec, entity, k)
    if face == "sql":
        return _run_sql(spark, query, readings, spec, entity, k, view or f"tidewatt_{uuid.uuid4().hex}")
    return _run_df(query, readings, spec, entity, k)


def _run_df(query, readings, spec, entity, k) -> Tables:
    if query == "q1":
        return Tables({"result": df.yearly(readings, spec)})
    if query == "q2":
        months = df.monthly(readings, spec, entity)
        top = df.monthly_top(months, spec, k)
        return Tables({"all": months.orderBy("date"), "top": top}, months)
    hours = df.hourly(readings, spec)
    stats = df.hourly_stats(hours, spec)
    return Tables({"hourly": hours.orderBy(spec.entity_name, "hour"), "stats": stats}, hours)


def _run_sql(spark, query, readings, spec, entity, k, view) -> Tables:
    table = register_readings(readings, f"{view}_readings")
    if query == "q1":
        return Tables({"result": sql.yearly(spark, table, spec)}, None, (table,))
    if query == "q2":
        months = register_readings(sql.monthly(spark, table, spec, entity), f"{view}_monthly")
        top = sql.monthly_top(spark, months, spec, k)
        return Tables({"all": sql.sorted_rows(spark, months, ["date"]), "top": top}, months, (table, months))
    hours = register_readings(sql.hourly(spark, table, spec), f"{view}_hourly")
    profile = sql.sorted_rows(spark, hours, [spec.entity_name, "hour"])
    return Tables({"hourly": profile, "stats": sql.hourly_stats(spark, hours, spec)}, hours, (table, hours))


def _run_rdd(spark, query, readings, spec, entity, k) -> Tables:
    if query == "q1":
        return Tables({"result": rdd.yearly(spark, readings, spec)})
    if query == "q2":
        months = rdd.month_rows(readings, spec, entity)
        top = rdd.monthly_top(spark, months, spec, k)
        return Tables({"all": rdd.monthly(spark, months, spec), "top": top})
    hours = rdd.hour_rows(readings, spec)
    stats = rdd.hourly_stats(spark, hours, spec)
    return Tables({"hourly": rdd.hourly(spark, hours, spec), "stats": stats})


@contextmanager
def kept(spark: SparkSession, tables: Tables):
    """Keep the aggregate that both of a query's outputs need, then let it and the views go (PER-1, PER-2).

    It has one row per month, or per hour and entity, so a second copy costs
    nothing and spares a new scan when an executor is lost.  A view is cached by
    name.  The RDD face needs nothing: its second job finds the shuffled groups of
    the first.
    """
    shared = tables.shared
    if isinstance(shared, str):
        spark.catalog.cacheTable(shared, StorageLevel.MEMORY_AND_DISK_2)
    elif shared is not None:
        shared.persist(StorageLevel.MEMORY_AND_DISK_2)
    try:
        yield
    finally:
        if isinstance(shared, str):
            spark.catalog.uncacheTable(shared)
        elif shared is not None:
            shared.unpersist()
        for view in tables.views:
            spark.catalog.dropTempView(view)


def record_layout(query: str, spec: ReadingSpec, entity: str | None) -> tuple[str, RecordLayout]:
    """Which output of a query is exported as records, and how."""
    if query == "q1":
        return "result", yearly_layout(spec)
    if query == "q2":
        return "top", ranking_layout(spec, entity)
    return "stats", percentile_layout(spec, PROBABILITIES)


def chart_series(
    query: str, results: Mapping[str, DataFrame], spec: ReadingSpec, labels: Mapping[str, str]
) -> dict[str, DataFrame]:
    """The series behind a query's charts, one per metric (SER-1..6).

    ``labels`` names the entities to draw.
    """
    if query == "q1":
        return {
            m.name: split_series(results["result"], spec, "year", f"{m.name}-mean", labels)
            for m in spec.metrics
        }
    if query == "q2":
        return {m.name: single_series(results["all"], "date", m.label, m.label) for m in spec.metrics}
    return {
        m.name: split_series(results["hourly"], spec, "hour", m.label, labels) for m in spec.metrics
    }


def store_records(spark: SparkSession, records: DataFrame, base: str, query: str) -> str:
    """Apply records to a query's store under ``base``; its path.

    Only the buckets that the records touch are read and written (see ``sinks.store``).
    Records of an earlier period that come late are added like any others.
    """
    store = RecordStore(f"{base}/{query}")
    store.upsert(records)
    return store.path


def together(spark: SparkSession, tasks: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent outputs at the same time, each a Spark job of its own; what each returned, by name.

    Every thread has its scheduler pool, so that under ``spark.scheduler.mode`` FAIR none waits for
    another; under FIFO the later ones take the cores that the earlier ones leave.  All
    outputs end before the first error, if any, is raised.
    """

    def pooled(name: str, task: Callable[[], Any]) -> Callable[[], Any]:
        def run() -> Any:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return task()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        started = {name: pool.submit(pooled(name, task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in started.items()}


def run_pipeline(
    spark: SparkSession,
    query: str,
    face: str,
    sources: str | Sequence[str],
    spec: ReadingSpec,
    out: str,
    labels: Mapping[str, str],
    entity: str | None = None,
    columns: Columns | None = None,
    policy: str = "per_metric",
    run_id: str | None = None,
    expected: Expected | None = None,
    by_file: Mapping[str, Columns] | None = None,
) -> dict[str, str]:
    """Ingest raw files, run a query and write every output (JOB-1).

    Returns the path of each output: the clean dataset and its report, the result
    folders, CSV files of one ordered copy each, the store of records, and chart series.  What was
    asked for is checked before anything is read.  ``expected`` names the years that must
    have come for each entity: if one has no accepted row, the run ends with
    ``MissingReadings`` after ingest, before the query (ING-7).  Outputs that only need the
    results are written at the same time.
    """
    check_choice(query, face, entity)
    run_id = check_run_id(run_id or new_run_id())
    out = out.rstrip("/")
    raw = read_raw(spark, sources, spec, columns, by_file=by_file)
    # The RDD face reads the CSV copy; for the others it is one more output.
    data = ingest(raw, spec, f"{out}/data/{run_id}", policy, expected=expected, text=face == "rdd")
    check_expected(data)
    only = entity if query == "q2" else None
    tables = run_query(spark, query, face, _input(spark, face, data, policy, only), spec, entity)

    def report() -> str:
        path = f"{out}/report/{run_id}"
        ingest_report(spark, data).write.option("header", True).csv(path)
        return path

    def results() -> dict[str, str]:
        with kept(spark, tables):
            return {
                kind: write_result(table, f"{out}/output", query, face, run_id, None if kind == "result" else kind)
                for kind, table in tables.outputs.items()
            }

    copies = {} if face == "rdd" else {"text": partial(write_text, spark, data)}
    first = together(spark, {"results": results, "report": report, **copies})
    paths = {"data": data.path, "report": first["report"], **first["results"]}
    found = {
        kind: read_result(spark, paths[kind], table.schema, [REQUIRED[kind]])
        for kind, table in tables.outputs.items()
    }
    tasks: dict[str, Callable[[], str]] = {}
    for kind, result in found.items():
        group = [] if kind == "all" else [ranking_order(spec) if kind == "top" else spec.entity_name]
        copy = result.orderBy(*group, REQUIRED[kind])
        tasks[f"csv_{kind}"] = partial(write_single_csv, copy, f"{out}/csv/{run_id}/{query}_{kind}.csv")
    kind, layout = record_layout(query, spec, entity)
    records = hash_records(found[kind], layout)
    tasks["records"] = partial(store_records, spark, records, f"{out}/records", query)
    for name, series in chart_series(query, found, spec, labels).items():
        tasks[f"series_{name}"] = partial(write_single_csv, series, f"{out}/series/{run_id}/{query}_{name}.csv")
    return paths | together(spark, tasks)


def _input(spark: SparkSession, face: str, data: Dataset, policy: str, entity: str | None) -> DataFrame:
    """The RDD face starts from the CSV copy, of one entity's folder if only that is asked for."""
    source = data.text_rows(spark, entity) if face == "rdd" else data.clean(spark)
    return as_readings(source, data.spec, policy)
