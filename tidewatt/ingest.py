"""From raw yearly CSV files to a clean dataset in Parquet and CSV."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.operators.stats import row_counts
from tidewatt.sources.files import SOURCE_NAME, literal_path, source_entity, source_headers, source_year
from tidewatt.sources.readings import check_policy, typed
from tidewatt.spec import ReadingSpec, quoted

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


Columns = Mapping[str, str | Sequence[str]]


def column_places(
    header: tuple[str, ...], file: str, spec: ReadingSpec, columns: Columns, by_file: Mapping[str, Columns]
) -> tuple[int | None, ...]:
    """Where a file has each of the spec's columns; None for an entity column that it lacks."""
    wanted = dict(columns)
    for pattern, own in by_file.items():
        if re.search(pattern, file):
            wanted |= own
    places: list[int | None] = []
    for column in spec.source_columns:
        given = wanted.get(column, column)
        names = [given] if isinstance(given, str) else list(given)
        name = next((n for n in names if n in header), None)
        if name is None and column != spec.entity_col:
            raise ValueError(f"no column {' or '.join(map(repr, names))} in the raw header {list(header)} of {file}")
        if name is not None and header.count(name) > 1:
            raise ValueError(f"column {name!r} stands twice in the raw header {list(header)} of {file}")
        places.append(None if name is None else header.index(name))
    return tuple(places)


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: ReadingSpec,
    columns: Columns | None = None,
    pattern: str = SOURCE_NAME,
    by_file: Mapping[str, Columns] | None = None,
) -> DataFrame:
    """All raw files as text, columns picked and renamed (ING-1, ING-2, PRJ-4).

    ``columns`` maps the names in ``spec`` to names in the raw headers; of several
    names given for one column the first that a header has counts.  ``by_file`` maps
    regular expressions to such mappings for the files whose path they match; these come first.
    Files may differ in the order of their columns, in further columns, and in names: a
    catalogue of all headers tells where each file has its columns, files that have them at the
    same places are one scan, and the scans are united by name.  A file that lacks a
    column, or has it twice, is an error that names it, before any row is read.
    ``source`` is the file's path; an entity column that a file lacks is taken from its name.
    Both are worked out once a file and meet the rows by the file's URI, in a broadcast join.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    layouts: dict[tuple, list[str]] = {}
    headers = source_headers(spark, paths)
    for (file, _), header in headers.items():
        places = column_places(header, file, spec, columns or {}, by_file or {})
        layouts.setdefault((len(header), places), []).append(file)
    if not layouts:
        raise ValueError(f"no raw file with a header line under {paths}")
    source = F.url_decode(F.replace(F.col("uri"), F.lit("+"), F.lit("%2B")))
    files = spark.createDataFrame([(uri,) for _, uri in headers], "uri string")
    named = F.broadcast(files.select("uri", source.alias("source"), source_entity(source, pattern).alias("entity")))
    scans = []
    for (width, places), own in layouts.items():
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
        scan = spark.read.schema(schema).option("header", True).csv([literal_path(file) for file in own])
        picked = [
            F.col("entity" if place is None else f"c{place}").alias(column)
            for column, place in zip(spec.source_columns, places, strict=True)
        ]
        scans.append(scan.select("*", F.col("_metadata.file_path").alias("uri")).join(named, "uri", "left").select(*picked, "source"))
    return reduce(DataFrame.unionByName, scans)


def source_inventory(
    raw: DataFrame, spec: ReadingSpec, pattern: str = SOURCE_NAME
) -> DataFrame:
    """Rows per yearly source, by the entity and year in its name (SRC-3, ING-1, ING-4)."""
    return (
        raw.groupBy("source")
        .agg(F.count("*").alias("rows"))
        .groupBy(
            source_entity(F.col("source"), pattern).alias(spec.entity_name),
            source_year(F.col("source"), pattern).alias("year"),
        )
        .agg(F.sum("rows").alias("rows"))
        .orderBy(spec.entity_name, "year")
    )


def missing_sources(
    inventory: DataFrame, spec: ReadingSpec, entities: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """Expected yearly sources of which no row came (ING-7): every entity in every year is expected."""
    one = inventory.sparkSession.range(1)
    expected = one.select(
        F.explode(F.array(*map(F.lit, entities)).cast("array<string>")).alias(spec.entity_name),
        F.array(*map(F.lit, years)).cast("array<int>").alias("years"),
    ).select(spec.entity_name, F.explode("years").alias("year"))
    missing = expected.join(inventory.filter("rows > 0"), [spec.entity_name, "year"], "left_anti")
    return missing.orderBy(spec.entity_name, "year")


def reject_reason(spec: ReadingSpec, policy: str) -> Column:
    """Name of the first field that makes the policy refuse a row, NULL if none."""
    checks = [F.when(F.col("time").isNull(), "time")]
    if check_policy(policy) == "strict_row":
        checks += [F.when(F.col(name).isNull(), name) for name in spec.metric_names]
    return F.coalesce(*checks)


def judged(raw: DataFrame, spec: ReadingSpec, policy: str = "per_metric") -> DataFrame:
    """Raw rows in clean column names and types, with ``verdict`` and, for refused
    rows, ``reason`` and the raw fields as JSON text (ING-2, FLT-4, FLT-5)."""
    fields = [*spec.source_columns, "source"]
    kept = F.struct(*[F.col(quoted(c)) for c in fields]).alias("raw")
    reason = reject_reason(spec, policy).alias("reason")
    names = ["time", spec.entity_name, *spec.metric_names]
    clean = [F.col(n).alias(c) for n, c in zip(names, spec.source_columns, strict=True)]
    refused = F.col("reason").isNotNull()
    return (
        typed(raw, spec, keep=[kept])
        .select(*clean, reason, "raw")
        .withColumn("raw", F.when(refused, F.to_json("raw")))
        .withColumn("verdict", F.when(refused, "rejected").otherwise("clean"))
    )


LAYOUTS = ("compacted", "as_read")


def compacted(df: DataFrame, *columns: str) -> DataFrame:
    """Few, evenly sized files per value of ``columns`` (ING-3, ING-4), by one shuffle.

    Adaptive execution, Spark's default, cuts a value that holds much of the data
    into several tasks and packs small ones together.
    """
    return df.hint("rebalance", *columns)


Expected = Mapping[str, Sequence[int]]


@dataclass(frozen=True)
class Counts:
    """Rows counted by the pass that wrote them: ``kept`` by (entity, year) as far as expected, ``others``
    for all further accepted rows, ``refused`` by reason."""

    kept: Mapping[tuple[str, int], int]
    others: int
    refused: Mapping[str, int]


@dataclass(frozen=True)
class Dataset:
    """A clean dataset on disk; ``counts`` if it was written with expectations."""

    path: str
    spec: ReadingSpec
    counts: Counts | None = field(default=None, compare=False)

    @property
    def table(self) -> str:
        return f"{self.path}/parquet"

    @property
    def text(self) -> str:
        return f"{self.path}/csv"

    def clean(self, spark: SparkSession) -> DataFrame:
        """Accepted rows; a filter on the entity reads that entity's folder only."""
        return self._read(spark, "clean").select(*self.spec.source_columns)

    def text_rows(self, spark: SparkSession, entity: str | None = None) -> DataFrame:
        """The CSV copy as text columns; with ``entity``, that entity's folder only."""
        names = [*self.spec.source_columns, "entity"]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        rows = spark.read.schema(schema).option("header", True).csv(self.text)
        if entity is not None:
            rows = rows.filter(F.col("entity") == entity)
        return rows.select(*self.spec.source_columns)

    def rejects(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "rejected").select("raw", "reason")

    def _read(self, spark: SparkSession, verdict: str) -> DataFrame:
        types = {self.spec.time_col: "timestamp_ntz", "reason": "string", "raw": "string"}
        types |= {m.source: "double" for m in self.spec.metrics}
        types |= {"verdict": "string", self.spec.entity_col: "string"}
        schema = ", ".join(f"{quoted(name)} {kind}" for name, kind in types.items())
        return spark.read.schema(schema).parquet(self.table).filter(F.col("verdict") == verdict)


class MissingReadings(ValueError):
    """Expected entities and years of which no row was accepted."""

    def __init__(self, missing: Sequence[tuple[str, int]]) -> None:
        self.missing = list(missing)
        super().__init__("no accepted rows of " + ", ".join(f"{entity} {year}" for entity, year in self.missing))


def counters(spec: ReadingSpec, expected: Expected) -> tuple[list[tuple[str, int]], list[Column]]:
    """The expected pairs, and aggregates that count their rows, all other accepted rows and the refused ones."""
    pairs = list(dict.fromkeys((entity, int(year)) for entity, years in expected.items() for year in years))
    clean = F.col("verdict") == "clean"
    whose, year = F.col(quoted(spec.entity_col)), F.year(F.col(quoted(spec.time_col)))
    counted = [
        F.count_if(clean & whose.eqNullSafe(who) & (year == when)).alias(f"kept_{k}") for k, (who, when) in enumerate(pairs)
    ]
    refused = [F.count_if(F.col("reason") == name).alias(f"refused_{k}") for k, name in enumerate(reasons(spec))]
    return pairs, [F.count_if(clean).alias("clean"), *counted, *refused]


def reasons(spec: ReadingSpec) -> list[str]:
    return ["time", *spec.metric_names]


def check_expected(data: Dataset) -> None:
    """Raise ``MissingReadings`` if an expected entity and year has no accepted row (ING-7)."""
    missing = [pair for pair, rows in data.counts.kept.items() if not rows] if data.counts else []
    if missing:
        raise MissingReadings(missing)


def ingest(
    raw: DataFrame,
    spec: ReadingSpec,
    path: str,
    policy: str = "per_metric",
    layout: str = "compacted",
    expected: Expected | None = None,
    text: bool = True,
) -> Dataset:
    """Write the clean dataset as Parquet and CSV (ING-2..6, SNK-3).

    Entities become folders, so there should be few of them (countries, not meters).
    ``layout`` "compacted" shuffles once for few, even files; "as_read" writes where
    rows are read, without a shuffle: right for large raw files of one entity each.
    The raw text is parsed once: accepted and refused rows go to one Parquet
    table, split by verdict and entity.  The CSV copy is made from that table,
    file by file and without another shuffle.  Nothing of the input's size is
    cached, and losing an executor only repeats its tasks.
    With ``expected`` (years by entity) the writing pass counts its rows on the way:
    after the shuffle, where each task's counts are taken once however often it is tried.
    ``text`` False leaves the CSV copy to a later ``write_text``.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, use one of {LAYOUTS}")
    spark = raw.sparkSession
    data = Dataset(path.rstrip("/"), spec)
    rows = judged(raw, spec, policy)
    if layout == "compacted":
        rows = compacted(rows, "verdict", spec.entity_col)
    if expected is None:
        rows.write.partitionBy("verdict", spec.entity_col).parquet(data.table)
    else:
        pairs, aggregates = counters(spec, expected)
        watch = Observation()
        rows.observe(watch, *aggregates).write.partitionBy("verdict", spec.entity_col).parquet(data.table)
        seen = watch.get
        kept = {pair: seen[f"kept_{k}"] for k, pair in enumerate(pairs)}
        refused = {name: seen[f"refused_{k}"] for k, name in enumerate(reasons(spec))}
        data = replace(data, counts=Counts(kept, seen["clean"] - sum(kept.values()), refused))
    if text:
        write_text(spark, data)
    return data


def write_text(spark: SparkSession, data: Dataset) -> str:
    """The CSV copy of a dataset, one folder an entity (ING-6)."""
    spec = data.spec
    (
        data.clean(spark)
        .withColumn("entity", F.col(quoted(spec.entity_col)))
        .write.partitionBy("entity")
        .option("header", True)
        .option("timestampNTZFormat", TIME_FORMAT)
        .csv(data.text)
    )
    return data.text


def ingest_report(spark: SparkSession, data: Dataset) -> DataFrame:
    """Rows kept per entity and year, and rows refused per reason (ING-7, AGG-7).

    Taken from the counts of the writing pass, if it accepted expected rows only; else the dataset is read.
    """
    spec = data.spec
    if data.counts and not data.counts.others:
        kept = [("clean", who, year, None, rows) for (who, year), rows in data.counts.kept.items() if rows]
        refused = [("rejected", None, None, reason, rows) for reason, rows in data.counts.refused.items() if rows]
        schema = f"verdict string, {quoted(spec.entity_name)} string, year int, reason string, rows long"
        return spark.createDataFrame(kept + refused, schema).orderBy("verdict", spec.entity_name, "year", "reason")
    clean = data.clean(spark).select(
        F.col(quoted(spec.time_col)).alias("time"),
        F.col(quoted(spec.entity_col)).alias(spec.entity_name),
    )
    kept = row_counts(clean, spec).select(
        F.lit("clean").alias("verdict"), F.col(spec.entity_name), "year",
        F.lit(None).cast("string").alias("reason"), "rows",
    )
    refused = data.rejects(spark).groupBy("reason").agg(F.count("*").alias("rows")).select(
        F.lit("rejected").alias("verdict"),
        F.lit(None).cast("string").alias(spec.entity_name),
        F.lit(None).cast("int").alias("year"),
        "reason", "rows",
    )
    return kept.unionByName(refused).orderBy("verdict", spec.entity_name, "year", "reason")
