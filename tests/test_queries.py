"""Every query of the engine against its SQL formulation in another engine.

Queries on training data, some of which SQL cannot express, have their own tests.
"""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from riskweave.checks import oracle, registry

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    con = duckdb.connect()
    for table in ("customer", "orders", "lineitem"):
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _rows(table) -> tuple[list[str], list[str]]:
    names = sorted(table.column_names)
    columns = [table[name].to_pylist() for name in names]
    return names, sorted(map(repr, zip(*columns, strict=True)))


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, other_engine, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    expected = other_engine.sql(ORACLE[name]).to_arrow_table()
    assert found.num_rows > 0
    assert _rows(found) == _rows(expected)
    types = {field.name: str(field.type) for field in found.schema}
    assert types == {field.name: str(field.type) for field in expected.schema}


def test_flagship_runs(spark):
    result = driver.entry(spark)
    assert result.columns == ["hicn", "lookup_key", "cms_risk_score", "variables"]
    assert result.count() > 0
