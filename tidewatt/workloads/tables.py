"""Readings taken from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.ingest import compacted
from tidewatt.scratch import scratch_dir
from tidewatt.sources.readings import as_readings
from tidewatt.spec import Metric, ReadingSpec

SHIPMENTS = ReadingSpec(
    time_col="l_shipdate",
    entity_col="l_linestatus",
    metrics=(
        Metric("price", "l_extendedprice", "extended-price"),
        Metric("discount", "l_discount"),
    ),
    entity_name="status",
)
EVENTS = ReadingSpec(
    time_col="ts",
    entity_col="event_type",
    metrics=(Metric("value", "value", "mean-value"), Metric("k", "k")),
    entity_name="kind",
)
# Entity of the one-entity queries, and the entities drawn in charts.
ONE_STATUS = "O"
STATUS_LABELS = {"F": "Finished", "O": "Open"}
KIND_LABELS = {
    "click": "Clicks", "error": "Errors", "purchase": "Purchases", "signup": "Signups", "view": "Views",
}
# The years line items are expected for, one more than there are.
EXPECTED_YEARS = list(range(1995, 2003))
# The years of the events.
EVENT_YEARS = [2024]
# Buckets of the store of yearly records, and the record that is updated there.
RECORD_BUCKETS = 8
UPDATED_KEY = "Q1:O:1998"

# How raw event lines are spoiled, by what they hold: SQL both engines read the same
# way.  All events are written; refusing some of them is what ingest is there for.
BAD_TIME = "k < 8"
T_TIME = "k BETWEEN 8 AND 15"
WORD_VALUE = "k BETWEEN 40 AND 50"
EMPTY_VALUE = "k BETWEEN 51 AND 60"
NAN_VALUE = "k BETWEEN 61 AND 70"
SHORT_LINE = "value < 10"
LONG_LINE = "value BETWEEN 10 AND 20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "lineitem"), SHIPMENTS)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("double").alias("k")
    return table(spark, sf_dir, "events").select("ts", "event_type", "value", k)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(event_rows(spark, sf_dir), EVENTS)


_written: dict[tuple[str, str, str], str] = {}


def raw_folder(spark: SparkSession, sf_dir: str, write: Callable[[SparkSession, str], str]) -> str:
    """Raw files written once per session and folder of test tables, as if they had come from outside."""
    key = (spark.sparkContext.applicationId, sf_dir, write.__name__)
    if key not in _written:
        _written[key] = write(spark, sf_dir)
    return _written[key]


def zoned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose time is an instant: their own time is taken as UTC."""
    parts = [F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.minute("ts"), F.second("ts")]
    return event_rows(spark, sf_dir).withColumn("ts", F.make_timestamp_ltz(*parts, F.lit("UTC")))


def write_raw_events(spark: SparkSession, sf_dir: str) -> str:
    """All events as raw yearly CSV files per event type, some lines spoiled.

    Each line is one column whose name is the header line; the tab separator
    keeps the writer from quoting it.
    """
    line = F.concat(
        F.expr(f"""CASE WHEN {BAD_TIME} THEN 'bad'
            WHEN {T_TIME} THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
            ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"""),
        F.lit(","),
        F.expr(f"""CASE WHEN {WORD_VALUE} THEN 'abc' WHEN {EMPTY_VALUE} THEN ''
            WHEN {NAN_VALUE} THEN 'nan' ELSE CAST(value AS STRING) END"""),
        F.expr(f"""CASE WHEN {SHORT_LINE} THEN '' WHEN {LONG_LINE} THEN concat(',', k, ',extra')
            ELSE concat(',', k) END"""),
    )
    source = F.concat("event_type", F.lit("_"), F.year("ts"), F.lit("_hourly"))
    path = scratch_dir(spark, "raw-events")
    rows = event_rows(spark, sf_dir).select(source.alias("source"), line.alias("Time,Value,K number"))
    (
        compacted(rows, "source")
        .write.partitionBy("source")
        .option("header", True)
        .option("sep", "\t")
        .csv(path)
    )
    return path


RAW_COLUMNS = {"ts": "Time", "value": "Value", "k": "K number"}


def write_raw_shipments(spark: SparkSession, sf_dir: str) -> str:
    """All line items as raw yearly CSV files per line status."""
    source = F.concat("l_linestatus", F.lit("_"), F.year("l_shipdate"), F.lit("_hourly"))
    path = scratch_dir(spark, "raw-shipments")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_extendedprice", "l_discount", source.alias("source")
    )
    (
        compacted(rows, "source")
        .write.partitionBy("source")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


# Two layouts of raw line items: the first until this year, then another order, other names and a further column.
NEW_LAYOUT_FROM = 1998
SHIPMENT_COLUMNS = {"l_shipdate": ["l_shipdate", "Shipped at"], "l_extendedprice": ["l_extendedprice", "Price (net)"]}
SHIPMENT_COLUMNS_BY_FILE = {r"_(1998|1999|2\d{3})_hourly": {"l_discount": "Reduction"}}


def write_two_layouts(spark: SparkSession, sf_dir: str) -> str:
    """All line items as raw yearly CSV files per line status, the later years in another layout."""
    lines = table(spark, sf_dir, "lineitem")
    source = F.concat("l_linestatus", F.lit("_"), F.year("l_shipdate"), F.lit("_hourly")).alias("source")
    later = F.year("l_shipdate") >= NEW_LAYOUT_FROM
    path = scratch_dir(spark, "raw-layouts")
    parts = [
        lines.filter(~later).select("l_shipdate", "l_extendedprice", "l_discount", source),
        lines.filter(later).select(
            F.col("l_discount").alias("Reduction"), F.col("l_discount").alias("l_discount"),
            F.lit("a, note").alias("Remark"), F.col("l_extendedprice").alias("Price (net)"),
            F.col("l_shipdate").alias("Shipped at"), source,
        ).withColumn("l_discount", -F.col("l_discount")),
    ]
    for part in parts:
        (
            compacted(part, "source").write.mode("append").partitionBy("source")
            .option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        )
    return path
