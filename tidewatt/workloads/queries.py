"""Every operator as a query over the test tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.ingest import MissingReadings, ingest, ingest_report, missing_sources, read_raw, source_inventory
from tidewatt.jobs import (
    REQUIRED,
    Tables,
    chart_series,
    record_layout,
    run_pipeline,
    run_query,
    store_records,
)
from tidewatt.operators.rankings import ranked_extremes
from tidewatt.operators.stats import period_means, row_counts
from tidewatt.operators.timing import run_times, timing_summary
from tidewatt.plans import df, rdd, sql
from tidewatt.scratch import scratch_dir
from tidewatt.sinks.records import flat_records, hash_records, upsert_records
from tidewatt.sinks.results import write_result, write_single_csv, write_timing_report
from tidewatt.sinks.store import RECORD, RecordStore
from tidewatt.sources.files import discover_sources, latest_result, list_files, read_result
from tidewatt.sources.readings import as_readings, read_readings, register_readings, union_readings
from tidewatt.spec import ReadingSpec
from tidewatt.workloads.tables import (
    EVENT_YEARS,
    EVENTS,
    EXPECTED_YEARS,
    KIND_LABELS,
    ONE_STATUS,
    RAW_COLUMNS,
    RECORD_BUCKETS,
    SHIPMENT_COLUMNS,
    SHIPMENT_COLUMNS_BY_FILE,
    SHIPMENTS,
    STATUS_LABELS,
    UPDATED_KEY,
    events,
    raw_folder,
    shipments,
    table,
    write_raw_events,
    write_raw_shipments,
    write_two_layouts,
    zoned_events,
)

Query = Callable[[SparkSession, str], DataFrame]

# Two run ids; the names sort by time.
FIRST_RUN, SECOND_RUN = "20240101000000", "20240102000000"


def inputs(query: str) -> tuple[Callable[[SparkSession, str], DataFrame], ReadingSpec]:
    return (events, EVENTS) if query == "q3" else (shipments, SHIPMENTS)


def tables(spark: SparkSession, sf_dir: str, query: str, face: str = "df") -> Tables:
    source, spec = inputs(query)
    return run_query(spark, query, face, source(spark, sf_dir), spec, ONE_STATUS)


def answer(spark: SparkSession, sf_dir: str, query: str, face: str, kind: str) -> DataFrame:
    return tables(spark, sf_dir, query, face).outputs[kind]


# --- the same queries from differently arranged inputs -----------------------


def q1_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with different column orders."""
    both = shipments(spark, sf_dir)
    is_open = F.col(SHIPMENTS.entity_name).eqNullSafe(ONE_STATUS)
    rest = both.filter(~is_open).select("discount", "price", SHIPMENTS.entity_name, "time")
    return df.yearly(union_readings([both.filter(is_open), rest]), SHIPMENTS)


def q3_union_all_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two per-entity views, united in SQL."""
    both = events(spark, sf_dir)
    is_click = F.col(EVENTS.entity_name).eqNullSafe("click")
    views = [
        register_readings(both.filter(is_click), "workload_clicks"),
        register_readings(both.filter(~is_click), "workload_others"),
    ]
    united = register_readings(sql.union_all(spark, views, EVENTS), "workload_united")
    hours = register_readings(sql.hourly(spark, united, EVENTS), "workload_united_hourly")
    return sql.sorted_rows(spark, hours, [EVENTS.entity_name, "hour"])


def q1_two_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs of the RDD face, united as states of their groups."""
    both = shipments(spark, sf_dir)
    is_open = F.col(SHIPMENTS.entity_name).eqNullSafe(ONE_STATUS)
    return rdd.yearly(spark, [both.filter(is_open), both.filter(~is_open)], SHIPMENTS)


def wide_means(spark: SparkSession, sf_dir: str, face: str) -> DataFrame:
    """Prices of 10^10 to 10^14 with their cents, where doubles keep few decimals."""
    lines = table(spark, sf_dir, "lineitem")
    wide = lines.withColumn("l_extendedprice", F.rint(F.col("l_extendedprice") * 1e9) + 0.25)
    return run_query(spark, "q1", face, as_readings(wide, SHIPMENTS), SHIPMENTS).outputs["result"]


def q3_hourly_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written with instants and read by a clock two hours ahead of UTC."""
    path = scratch_dir(spark, "zoned")
    zoned_events(spark, sf_dir).write.parquet(path)
    spec = replace(EVENTS, zone="+02:00")
    return run_query(spark, "q3", "df", read_readings(spark, path, "parquet", spec), spec).outputs["hourly"]


def q1_literal_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without an entity column, named by a literal."""
    source = table(spark, sf_dir, "lineitem").drop("l_linestatus")
    return df.yearly(as_readings(source, SHIPMENTS, entity="all"), SHIPMENTS)


def top_k_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = period_means(shipments(spark, sf_dir), SHIPMENTS, "month")
    return ranked_extremes(months, SHIPMENTS, "date", 3, within=[SHIPMENTS.entity_name])


def yearly_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(shipments(spark, sf_dir), SHIPMENTS).orderBy(SHIPMENTS.entity_name, "year")


# --- ingest ------------------------------------------------------------------


def ingested_events(spark: SparkSession, sf_dir: str, policy: str):
    raw = read_raw(spark, raw_folder(spark, sf_dir, write_raw_events), EVENTS, RAW_COLUMNS)
    return ingest(raw, EVENTS, scratch_dir(spark, "events"), policy)


def text_time(readings: DataFrame, column: str = "time") -> DataFrame:
    return readings.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def ingested(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    return text_time(ingested_events(spark, sf_dir, policy).clean(spark), "ts")


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refused rows, with the raw text of their fields."""
    refused = ingested_events(spark, sf_dir, "strict_row").rejects(spark)
    fields = F.from_json("raw", "ts string, event_type string, value string, k string")
    return refused.select(fields.alias("f"), "reason").select("f.*", "reason")


def two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of yearly files in two layouts."""
    folder = raw_folder(spark, sf_dir, write_two_layouts)
    raw = read_raw(spark, folder, SHIPMENTS, SHIPMENT_COLUMNS, by_file=SHIPMENT_COLUMNS_BY_FILE)
    return text_time(ingest(raw, SHIPMENTS, scratch_dir(spark, "layouts")).clean(spark), "l_shipdate")


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows per entity and year, refused rows per reason; empty text where not given."""
    report = ingest_report(spark, ingested_events(spark, sf_dir, "strict_row"))
    return report.withColumn("year", F.col("year").cast("string")).fillna("")


def report_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the counts of the writing pass, for all kinds of the events' year."""
    raw = read_raw(spark, raw_folder(spark, sf_dir, write_raw_events), EVENTS, RAW_COLUMNS)
    expected = {kind: EVENT_YEARS for kind in KIND_LABELS}
    data = ingest(raw, EVENTS, scratch_dir(spark, "events"), "strict_row", expected=expected)
    return ingest_report(spark, data).withColumn("year", F.col("year").cast("string")).fillna("")


def csv_answer(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Q3 by the DataFrame face from the clean CSV copy."""
    data = ingested_events(spark, sf_dir, "per_metric")
    readings = read_readings(spark, f"{data.text}/*", "csv", EVENTS)
    return run_query(spark, "q3", "df", readings, EVENTS).outputs[kind]


def text_rdd_answer(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Q3 by the RDD face from the clean CSV copy."""
    data = ingested_events(spark, sf_dir, "strict_row")
    return run_query(spark, "q3", "rdd", rdd.from_text(spark, [f"{data.text}/*"], EVENTS), EVENTS).outputs[kind]


def sources_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per yearly source file."""
    raw = read_raw(
        spark, raw_folder(spark, sf_dir, write_raw_shipments), SHIPMENTS, {"l_linestatus": "not in the files"}
    )
    return source_inventory(raw, SHIPMENTS)


def sources_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected yearly sources that did not come."""
    return missing_sources(sources_read(spark, sf_dir), SHIPMENTS, list(STATUS_LABELS), EXPECTED_YEARS)


def sources_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity and year of the source files, without opening them."""
    found = discover_sources(spark, raw_folder(spark, sf_dir, write_raw_shipments))
    return found.select("entity", "year").distinct().orderBy("entity", "year")


def dual_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written as Parquet and as CSV, counted and averaged from each."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_linestatus", "l_extendedprice", "l_discount", F.lit("lineitem").alias("source")
    )
    data = ingest(rows, SHIPMENTS, scratch_dir(spark, "shipments"))
    copies = {
        "parquet": as_readings(data.clean(spark), SHIPMENTS),
        "csv": read_readings(spark, f"{data.text}/*", "csv", SHIPMENTS),
    }
    parts = [
        df.yearly(copy, SHIPMENTS).withColumn("copy", F.lit(name)) for name, copy in copies.items()
    ]
    return union_readings(parts).orderBy("copy", SHIPMENTS.entity_name, "year")


# --- written results ---------------------------------------------------------

def written(spark: SparkSession, sf_dir: str, query: str, kind: str) -> DataFrame:
    """A result written, found again as the newest run and read back."""
    result = answer(spark, sf_dir, query, "df", kind)
    base = scratch_dir(spark, "output")
    name = None if kind == "result" else kind
    write_result(result, base, query, "df", FIRST_RUN, name)
    return read_result(spark, latest_result(spark, base, query, "df", name), result.schema, [REQUIRED[kind]])


def newest_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with different contents; the later one is read."""
    result = answer(spark, sf_dir, "q1", "df", "result")
    base = scratch_dir(spark, "output")
    write_result(result, base, "q1", "df", SECOND_RUN)
    write_result(result.filter(f"status = '{ONE_STATUS}'"), base, "q1", "df", FIRST_RUN)
    newest = latest_result(spark, base, "q1", "df")
    run = F.lit(newest.rsplit("_", 1)[1])
    return read_result(spark, newest, result.schema, ["year"]).withColumn("run", run)


def single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written result copied in order to one file, read back with the number of files."""
    months = written(spark, sf_dir, "q2", "all").orderBy("date")
    path = write_single_csv(months, scratch_dir(spark, "single") + ".csv")
    rows = spark.read.schema(months.schema).option("header", True).csv(path)
    files = F.lit(list_files(spark, path).count())
    return rows.withColumn("files", files).orderBy("date")


def merged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items written in 40 ranges and merged: rows by year, files, and lines that are a header."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"))
    ranges = lines.repartitionByRange(40, "l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey", "l_linenumber")
    path = write_single_csv(ranges, scratch_dir(spark, "merged") + ".csv")
    files = F.lit(list_files(spark, path).count()).alias("files")
    headers = F.count_if(F.col("value") == ",".join(lines.columns)).alias("headers")
    by_year = spark.read.text(path).groupBy(F.substring_index("value", ",", -1).alias("year"))
    return by_year.agg(F.count("*").alias("rows"), headers).select("*", files).orderBy("year")


# --- records -----------------------------------------------------------------


def records_of(spark: SparkSession, sf_dir: str, query: str) -> tuple[DataFrame, list[str]]:
    spec = inputs(query)[1]
    kind, layout = record_layout(query, spec, ONE_STATUS)
    outputs = tables(spark, sf_dir, query).outputs
    return hash_records(outputs[kind], layout), list(layout.fields)


def records(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    return flat_records(*records_of(spark, sf_dir, query))


def records_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records of all line items, updated by those of one return flag.

    The update carries means only, so the stored extremes stay.
    """
    stored, fields = records_of(spark, sf_dir, "q1")
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    layout = record_layout("q1", SHIPMENTS, None)[1]
    newer = hash_records(df.yearly(as_readings(returned, SHIPMENTS), SHIPMENTS), layout)
    means = F.map_filter("value", lambda field, _: F.endswith(field, F.lit("_mean")))
    return flat_records(upsert_records(stored, newer.withColumn("value", means)), fields)


def records_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the later years stored first, those of the earlier years after them."""
    records, fields = records_of(spark, sf_dir, "q1")
    base = scratch_dir(spark, "records")
    late = F.substring_index("key", ":", -1).cast("int") >= 1998
    store_records(spark, records.filter(late), base, "q1")
    return flat_records(RecordStore(store_records(spark, records.filter(~late), base, "q1")).read(spark), fields)


def records_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all line items, then new means of one status and year: per record, the version that wrote its bucket.

    The files of the buckets that the update does not touch are those of the first version.
    """
    records, fields = records_of(spark, sf_dir, "q1")
    store = RecordStore(scratch_dir(spark, "records"), RECORD_BUCKETS)
    store.upsert(records)
    means = F.map_filter("value", lambda field, _: F.endswith(field, F.lit("_mean")))
    update = records.filter(F.col("key") == UPDATED_KEY).withColumn("value", F.transform_values(means, lambda _, v: F.concat(v, F.lit("!"))))
    version = store.upsert(update)
    folders = store.folders(version)
    parts = [
        spark.read.schema(RECORD).parquet(path).withColumn("version", F.lit(version.writes[bucket][1]))
        for bucket, path in folders.items()
    ]
    found = reduce(DataFrame.unionByName, parts)
    return found.select("key", "version", *[F.col("value")[name].alias(name) for name in fields])


# --- chart series, timing, whole run -----------------------------------------


def series(spark: SparkSession, sf_dir: str, query: str, metric: str) -> DataFrame:
    spec = inputs(query)[1]
    labels = KIND_LABELS if query == "q3" else STATUS_LABELS
    drawn = chart_series(query, tables(spark, sf_dir, query).outputs, spec, labels)[metric]
    return drawn.withColumn("time", F.col("time").cast("string"))


def measured_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as measured runs."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("query"),
        F.col("l_linestatus").alias("api"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run_no"),
        F.col("l_extendedprice").alias("seconds"),
    )


def timing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written summary of run times with the number of times in the written list."""
    base = scratch_dir(spark, "timing")
    summary, times = write_timing_report(measured_runs(spark, sf_dir), base, FIRST_RUN)
    schema = timing_summary(measured_runs(spark, sf_dir)).schema
    listed = spark.read.option("header", True).csv(times).groupBy("query", "api").agg(F.count("*").alias("listed"))
    return read_result(spark, summary, schema, ["query"]).join(listed, ["query", "api"]).orderBy("query", "api")


def full_run(spark: SparkSession, sf_dir: str, query: str, face: str, output: str) -> DataFrame:
    """A query from raw files to every output; one output is read back."""
    spec = inputs(query)[1]
    write = write_raw_events if query == "q3" else write_raw_shipments
    names = RAW_COLUMNS if query == "q3" else {"l_linestatus": "not in the files"}
    labels = KIND_LABELS if query == "q3" else STATUS_LABELS
    paths = run_pipeline(
        spark, query, face, raw_folder(spark, sf_dir, write), spec, scratch_dir(spark, "full"), labels,
        entity=ONE_STATUS, columns=names, policy="strict_row", run_id=FIRST_RUN,
    )
    if output == "records":
        kind, layout = record_layout(query, spec, ONE_STATUS)
        return flat_records(RecordStore(paths["records"]).read(spark), list(layout.fields))
    schema = tables(spark, sf_dir, query).outputs[output].schema
    return spark.read.schema(schema).option("header", True).csv(paths[f"csv_{output}"])


def gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that expects a year too many: what it says is missing, with the number of result files it wrote."""
    out = scratch_dir(spark, "gated")
    try:
        run_pipeline(
            spark, "q1", "df", raw_folder(spark, sf_dir, write_raw_shipments), SHIPMENTS, out, STATUS_LABELS,
            columns={"l_linestatus": "not in the files"}, run_id=FIRST_RUN,
            expected={status: EXPECTED_YEARS for status in STATUS_LABELS},
        )
        missing = []
    except MissingReadings as error:
        missing = error.missing
    results = list_files(spark, f"{out}/*").filter("path LIKE '%.csv' AND path NOT LIKE '%/data/%'").count()
    found = spark.createDataFrame(missing, f"{SHIPMENTS.entity_name} string, year int")
    return found.withColumn("results", F.lit(results)).orderBy(SHIPMENTS.entity_name, "year")


def queries() -> dict[str, Query]:
    faces = ("df", "sql", "rdd")
    found: dict[str, Query] = {}
    for query, kinds in (("q1", ("result",)), ("q2", ("all", "top")), ("q3", ("hourly", "stats"))):
        for kind in kinds:
            for face in faces:
                name = f"q1_{face}" if query == "q1" else f"{query}_{kind}_{face}"
                found[name] = partial(answer, query=query, face=face, kind=kind)
    found |= {
        "q1_union_by_name": q1_union_by_name,
        "q1_literal_entity": q1_literal_entity,
        "q3_union_all_sql": q3_union_all_sql,
        "top_k_per_entity": top_k_per_entity,
        "row_counts": yearly_row_counts,
        "ingest_strict": partial(ingested, policy="strict_row"),
        "ingest_per_metric": partial(ingested, policy="per_metric"),
        "ingest_rejects": rejected,
        "ingest_report": reported,
        "q3_hourly_csv": partial(csv_answer, kind="hourly"),
        "q3_hourly_text_rdd": partial(text_rdd_answer, kind="hourly"),
        "q3_stats_text_rdd": partial(text_rdd_answer, kind="stats"),
        "source_inventory": sources_read,
        "source_files": sources_listed,
        "dual_format_roundtrip": dual_format_roundtrip,
        "result_roundtrip": partial(written, query="q1", kind="result"),
        "top_roundtrip": partial(written, query="q2", kind="top"),
        "stats_roundtrip": partial(written, query="q3", kind="stats"),
        "latest_run": newest_of_two,
        "single_csv_roundtrip": single_file,
        "q1_records": partial(records, query="q1"),
        "q2_records": partial(records, query="q2"),
        "q3_records": partial(records, query="q3"),
        "records_upsert": records_upserted,
        "series_yearly_a": partial(series, query="q1", metric="price"),
        "series_yearly_b": partial(series, query="q1", metric="discount"),
        "series_monthly_a": partial(series, query="q2", metric="price"),
        "series_monthly_b": partial(series, query="q2", metric="discount"),
        "series_hourly_a": partial(series, query="q3", metric="value"),
        "series_hourly_b": partial(series, query="q3", metric="k"),
        "timing_summary": lambda spark, sf_dir: timing_summary(measured_runs(spark, sf_dir)),
        "run_times": lambda spark, sf_dir: run_times(measured_runs(spark, sf_dir)),
        "timing_report_roundtrip": timing_report,
        "full_run_df": partial(full_run, query="q3", face="df", output="hourly"),
        "full_run_sql": partial(full_run, query="q3", face="sql", output="records"),
        "full_run_rdd": partial(full_run, query="q3", face="rdd", output="records"),
        "q1_two_inputs_rdd": q1_two_inputs,
        "q3_hourly_zoned": q3_hourly_zoned,
        "records_backfill": records_backfilled,
        "ingest_missing_sources": sources_missing,
        "ingest_two_layouts": two_layouts,
        "ingest_report_counted": report_counted,
        "full_run_gate": gated_run,
        "merged_csv": merged_file,
        "records_buckets": records_touched,
    }
    for face, yearly, ranked in zip(faces, ("result", "records", "records"), ("top", "top", "records"), strict=True):
        found[f"full_run_q1_{face}"] = partial(full_run, query="q1", face=face, output=yearly)
        found[f"full_run_q2_{face}"] = partial(full_run, query="q2", face=face, output=ranked)
        found[f"wide_means_{face}"] = partial(wide_means, face=face)
    return found
