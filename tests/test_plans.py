"""The physical plans must stay what they should be at scale."""

import re

import pytest

from tidewatt.plans import df, sql
from tidewatt.sources.readings import as_readings, register_readings
from tidewatt.workloads.tables import EVENTS, ONE_STATUS, SHIPMENTS, events, shipments

SF = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def built(spark, face, query):
    if face == "df":
        lines, hits = shipments(spark, SF), events(spark, SF)
        return {
            "q1": lambda: df.yearly(lines, SHIPMENTS),
            "all": lambda: df.monthly(lines, SHIPMENTS, ONE_STATUS),
            "top": lambda: df.monthly_top(df.monthly(lines, SHIPMENTS, ONE_STATUS), SHIPMENTS),
            "hourly": lambda: df.hourly(hits, EVENTS),
            "stats": lambda: df.hourly_stats(df.hourly(hits, EVENTS), EVENTS),
        }[query]()
    lines = register_readings(shipments(spark, SF), "plan_lines")
    hits = register_readings(events(spark, SF), "plan_hits")
    months = register_readings(sql.monthly(spark, lines, SHIPMENTS, ONE_STATUS), "plan_months")
    hours = register_readings(sql.hourly(spark, hits, EVENTS), "plan_hours")
    return {
        "q1": lambda: sql.yearly(spark, lines, SHIPMENTS),
        "all": lambda: spark.table(months),
        "top": lambda: sql.monthly_top(spark, months, SHIPMENTS),
        "hourly": lambda: spark.table(hours),
        "stats": lambda: sql.hourly_stats(spark, hours, EVENTS),
    }[query]()


@pytest.mark.parametrize("face", ["df", "sql"])
@pytest.mark.parametrize("query", ["q1", "all", "top", "hourly", "stats"])
def test_one_scan_and_no_python(spark, face, query):
    plan = plan_of(built(spark, face, query))
    assert plan.count("FileScan parquet") == 1
    for slow in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop", "SortAggregate"):
        assert slow not in plan


@pytest.mark.parametrize("face", ["df", "sql"])
@pytest.mark.parametrize("query,shuffles", [("q1", 2), ("all", 1), ("top", 3), ("hourly", 1), ("stats", 3)])
def test_shuffles(spark, face, query, shuffles):
    """One shuffle of partial states per aggregate or window, one for a sorted result."""
    assert plan_of(built(spark, face, query)).count("Exchange") == shuffles


@pytest.mark.parametrize("face", ["df", "sql"])
def test_scan_reads_needed_columns_and_gets_the_filter(spark, face):
    plan = plan_of(built(spark, face, "all"))
    assert "EqualTo(l_linestatus,O)" in plan and "IsNotNull(l_shipdate)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]
    columns = {field.split(":")[0] for field in read.split(",")}
    assert columns == {"l_shipdate", "l_linestatus", "l_extendedprice", "l_discount"}


@pytest.mark.parametrize("face", ["df", "sql"])
def test_ranks_are_limited_before_the_shuffle(spark, face):
    plan = plan_of(built(spark, face, "top"))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_entity_filter_on_the_clean_dataset_prunes_folders(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidewatt.ingest import ingest

    rows = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("source", F.lit("x"))
    data = ingest(rows, SHIPMENTS, str(tmp_path / "clean"))
    readings = as_readings(data.clean(spark), SHIPMENTS)
    plan = plan_of(df.monthly(readings, SHIPMENTS, ONE_STATUS))
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert "verdict" in pruned and "l_linestatus" in pruned


@pytest.mark.parametrize("spec,source", [(SHIPMENTS, shipments), (EVENTS, events)])
def test_rdd_face_hands_python_batches_and_not_rows(spark, monkeypatch, spec, source):
    """Python sees each input row as part of an Arrow batch; RDD elements are states of groups."""
    from tidewatt.plans import rdd

    readings = source(spark, SF)
    calls, rows, real = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), rdd._batch_states

    def counted(batch, metrics):
        calls.add(1)
        rows.add(batch.num_rows)
        return real(batch, metrics)

    monkeypatch.setattr(rdd, "_batch_states", counted)
    assert rdd._grouped(readings, spec, "year").count() > 0
    assert rows.value == readings.count()
    assert calls.value <= readings.rdd.getNumPartitions() + rows.value // 10_000


def test_rdd_face_of_one_entity_reads_its_folder_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidewatt.ingest import ingest

    rows = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("source", F.lit("x"))
    data = ingest(rows, SHIPMENTS, str(tmp_path / "clean"), layout="as_read")
    readings = as_readings(data.text_rows(spark, ONE_STATUS), SHIPMENTS)
    files = readings.select("time").withColumn("file", F.input_file_name()).select("file").distinct().collect()
    assert files and all(f"entity={ONE_STATUS}" in r.file for r in files)
    plan = plan_of(readings)
    assert "entity" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
