from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload import registry

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{entry.DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    result = entry.queries()[name](spark, entry.DATA)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(result.columns)
    got = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    sql = entry.oracle_sql()[name]
    cursor = oracle.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
    assert got == sorted(cursor.fetchall(), key=repr)
    assert got, "a query without rows proves nothing"


def test_entry(spark):
    assert entry.entry(spark).columns == ["body", "partition", "records_found", "records_scraped", "failed", "skipped"]
