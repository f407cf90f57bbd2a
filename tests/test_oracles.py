"""Every query against its SQL on the smallest tables."""

import decimal

import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.QUERIES, entry_point.ORACLES
SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return int(value) if isinstance(value, decimal.Decimal) else value


def _rows(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark, duck, sf):
    result = QUERIES[name](spark, sf)
    columns = sorted(result.columns)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    types = {c: SPARK_TYPES[str(t)] for c, t in zip(expected.columns, expected.types, strict=True)}
    assert {c: t for c, t in result.dtypes} == types
    place = [expected.columns.index(c) for c in columns]
    got = _rows(tuple(r[c] for c in columns) for r in result.collect())
    want = _rows(tuple(r[i] for i in place) for r in expected.fetchall())
    assert got == want
    assert got or name == "country_missing"


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
