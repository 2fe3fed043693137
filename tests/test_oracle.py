"""Every registered query against its SQL, run by DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidewatt.workloads import oracle
from tidewatt.workloads import queries as workload

SF = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = workload.queries(), oracle.oracle_sql()



@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, str(SF))
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = by_name(result.columns, [tuple(r) for r in result.collect()])
    assert found == by_name(columns, expected.fetchall())
    assert found


def test_a_later_call_does_not_change_an_earlier_frame(spark):
    small = QUERIES["q2_top_sql"](spark, str(SF))
    expected = QUERIES["q2_top_df"](spark, str(SF)).collect()
    QUERIES["q2_top_sql"](spark, "/root/testdata/sf0.01")
    assert small.collect() == expected


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["year", "status"]
