"""Every registered query against its SQL twin: names, types and values."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidegate.plans.catalog import ORACLES, QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    result = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in result.description}
    order = list(described)
    want = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    assert columns == sorted(described)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == described
    assert len(got) == len(want) > 0
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).count() == 200
