"""Rankings and percentiles recomputed from published tables must be exact."""

import calendar

import pytest

from tests import golden
from tidewatt import ELECTRICITY
from tidewatt.operators.timing import recorded_runs, run_times, timing_summary
from tidewatt.plans import df, rdd, sql
from tidewatt.sinks.results import write_timing_report
from tidewatt.sources.readings import register_readings

MONTHS = golden.rows(golden.MONTHLY, str, float, float)
HOURS = golden.rows(golden.HOURLY, int, str, float, float)


def top(spark, face):
    months = spark.createDataFrame(MONTHS, "date string, `carbon-intensity` double, cfe double")
    if face == "df":
        return df.monthly_top(months, ELECTRICITY)
    if face == "sql":
        return sql.monthly_top(spark, register_readings(months, "golden_months"), ELECTRICITY)
    return rdd.monthly_top(spark, spark.sparkContext.parallelize(MONTHS), ELECTRICITY)


def stats(spark, face):
    hours = spark.createDataFrame(
        HOURS, "hour int, country string, `carbon-intensity` double, cfe double"
    )
    if face == "df":
        return df.hourly_stats(hours, ELECTRICITY)
    if face == "sql":
        return sql.hourly_stats(spark, register_readings(hours, "golden_hours"), ELECTRICITY)
    return rdd.hourly_stats(spark, spark.sparkContext.parallelize(HOURS), ELECTRICITY)


@pytest.mark.parametrize("face", ["df", "sql", "rdd"])
def test_rankings(spark, face):
    values = {m: (c, f) for m, c, f in MONTHS}
    expected = [
        (month, *values[month], order, rank)
        for order, months in golden.TOP.items()
        for rank, month in enumerate(months, start=1)
    ]
    found = top(spark, face)
    assert found.columns == ["date", "carbon-intensity", "cfe", "order_type", "rank"]
    assert [tuple(r) for r in found.collect()] == expected


@pytest.mark.parametrize("face", ["df", "sql", "rdd"])
def test_percentiles(spark, face):
    found = stats(spark, face)
    assert found.columns == ["country", "data", "min", "25-perc", "50-perc", "75-perc", "max"]
    assert [tuple(r) for r in found.collect()] == golden.STATS


def test_months_average_to_years():
    days = {m: calendar.monthrange(*map(int, m.split("-")))[1] for m, _, _ in MONTHS}
    for year, carbon, cfe in golden.rows(golden.YEARLY_ITALY, str, float, float):
        own = [row for row in MONTHS if row[0].startswith(year)]
        total = sum(days[m] for m, _, _ in own)
        assert sum(c * days[m] for m, c, _ in own) / total == pytest.approx(carbon, abs=2e-6)
        assert sum(f * days[m] for m, _, f in own) / total == pytest.approx(cfe, abs=2e-6)


def test_hours_average_to_years():
    years = golden.rows(golden.YEARLY_ITALY, int, float, float)
    days = [366 if calendar.isleap(year) else 365 for year, _, _ in years]
    for column in (1, 2):
        overall = sum(row[column] * d for row, d in zip(years, days, strict=True)) / sum(days)
        own = [row[column + 1] for row in HOURS if row[1] == "IT"]
        assert sum(own) / 24 == pytest.approx(overall, abs=2e-6)


def test_timing_summary(spark):
    runs = recorded_runs(spark, golden.RUNS)
    for row in timing_summary(runs).collect():
        mean, deviation = golden.RUN_SUMMARY[row.query, row.api]
        assert row.runs == 10
        assert row.mean_seconds == mean
        assert row.stdev_seconds == pytest.approx(deviation, abs=0.0101)
    listed = run_times(runs).filter("query = 'q1' AND api = 'df'").collect()
    assert [r.seconds for r in listed] == golden.RUNS["q1", "df"]


def test_timing_of_a_single_run_and_its_report(spark, tmp_path):
    runs = recorded_runs(spark, {("q1", "df"): [3.456]})
    summary, times = write_timing_report(runs, str(tmp_path), "20250101000000")
    assert [(tmp_path / p).name for p in (summary, times)] == [
        "performance_summary_20250101000000", "performance_runs_20250101000000",
    ]
    read = lambda path: [tuple(r) for r in spark.read.option("header", True).csv(path).collect()]
    assert read(summary) == [("q1", "df", "1", "3.46", "0.0")]
    assert read(times) == [("q1", "df", "1", "3.46")]
