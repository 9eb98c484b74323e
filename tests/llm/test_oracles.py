"""Queries of the llm operators that SQL can express, against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tarnwork.llm import queries

from .conftest import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        database.execute(f"create view {file.stem} as select * from '{file}'")
    result = database.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.select(*columns)) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_has_one_query(number):
    assert len([q for q in queries.queries() if q.startswith(f"op{number}_")]) == 1


@pytest.mark.parametrize("name", ["op2_template_decontamination", "op3_typed_chat", "op6_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
