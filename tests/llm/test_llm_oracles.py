"""Registered training-data queries against their SQL twins: names, types and values."""

from __future__ import annotations

import duckdb
import pytest

from tidegate.llm.queries import ORACLES, QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    result = con.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in result.description}
    order = list(described)
    want = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    assert columns == sorted(described)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == described
    assert len(got) == len(want) > 0
    assert sorted(map(repr, got)) == sorted(map(repr, want))
