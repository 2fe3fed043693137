"""Registered queries against their SQL, run by DuckDB on the same tables; all queries run."""

from pathlib import Path

import duckdb
import pytest

from tidewatt.llm import registry

SF = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in SF.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = registry.queries()[name](spark, str(SF))
    columns = sorted(found.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(expected, key=repr)
    assert expected


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries())
    assert numbers == list(range(1, 14))
