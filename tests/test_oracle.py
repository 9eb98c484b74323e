"""Every registered query against its SQL, on the driver tables."""

from __future__ import annotations

import os
import time
from pathlib import Path

import duckdb
import pytest

from tarnwork.plans import catalog

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(Path(DATA).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def kind(value):
    return type(value).__name__


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, database, name):
    started = time.time()
    df = catalog.QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Only the call to an outside service and the table function need Python workers.
    assert ("MapInArrow" in plan) == (name == "call_external")
    assert ("Python" in plan) == (name == "filled_hours") and "Pandas" not in plan
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    print(f"{name}: {len(got)} rows, {time.time() - started:.2f} s")
    result = database.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = comparable(columns, result.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a == b
        assert [kind(v) for v in a] == [kind(v) for v in b]
