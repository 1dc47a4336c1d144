"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from pricelake import workload
from pricelake.session import release

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert workload.queries().keys() == workload.oracle_sql().keys()
    assert workload.queries().keys() <= entry.queries().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "ranking"
    assert df.count() > 0


@pytest.mark.parametrize("name", list(workload.queries()))
def test_query(spark, duck, sf_dir, name):
    df = workload.queries()[name](spark, sf_dir)
    want = duck.execute(workload.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(df.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in want.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
    release(spark)
