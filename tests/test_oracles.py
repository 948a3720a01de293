"""Every registered query against its SQL.

ORACLE_SCALES names the scale factors, e.g. ``sf0.001,sf0.01,sf0.1``.
"""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from activation_mart import checks

ROOT = "/root/testdata"
SCALES = os.environ.get("ORACLE_SCALES", "sf0.01").split(",")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, SQL = checks.queries(), checks.oracles()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the driver's tables")

DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connections = {}

    def connect(scale):
        if scale not in connections:
            connections[scale] = duckdb.connect()
            for table in TABLES:
                path = f"{ROOT}/{scale}/{table}.parquet"
                connections[scale].sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        return connections[scale]

    return connect


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, duck, name, scale):
    ours = QUERIES[name](spark, f"{ROOT}/{scale}")
    theirs = duck(scale).sql(SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    types = {
        f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in ours.schema
    }
    assert types == {c: str(t).replace(" ", "") for c, t in zip(theirs.columns, theirs.types)}
    order = ", ".join(f'"{c}"' for c in columns)
    expected = theirs.query("result", f"SELECT {order} FROM result").fetchall()
    found = [tuple(row) for row in ours.select(*columns).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    assert driver.entry(spark).columns == ["AccountKey", "CreateDate", "BankKey", "BankName", "Channel"]
