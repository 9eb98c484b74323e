from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.checks import (
    AggregateBetween,
    Between,
    Equals,
    GreaterThan,
    NotNull,
    StablePopulation,
    failing_rows,
    run_checks,
)

PARCELS = [("p1", 12, "box"), ("p2", 48, "tube"), (None, 7, "box"), ("p4", 90, "sack"), ("p5", 33, "box"), ("p6", 50, "tube")]


@pytest.fixture(scope="module")
def parcels(spark):
    return spark.createDataFrame(PARCELS, "code string, weight int, shape string")


def results(df, *checks):
    return [tuple(r) for r in run_checks(df, checks).collect()]


def test_suite(parcels):
    got = results(
        parcels,
        Equals(column="shape", constant="box", mostly=0.9, name="boxes"),
        GreaterThan(column="weight", bound=30, mostly=0.5),
        NotNull(column="code", mostly=0.8, severity="warning"),
        Between(column="weight", min_value=10, max_value=95),
        AggregateBetween(column="weight", min_value=35, max_value=45),
    )
    assert got == [
        ("boxes", "shape", "critical", 6, 3, 0.5, None, False),
        ("greater_than(weight)", "weight", "critical", 6, 2, 4 / 6, None, True),
        ("not_null(code)", "code", "warning", 6, 1, 5 / 6, None, True),
        ("between(weight)", "weight", "critical", 6, 1, 5 / 6, None, False),
        ("aggregate_between(weight)", "weight", "critical", 6, None, None, 40.0, True),
    ]


def test_null_rules(spark):
    df = spark.createDataFrame([(3,), (None,), (30,)], "age int")
    got = results(
        df,
        GreaterThan(column="age", bound=10),
        Between(column="age", max_value=5),
        Equals(column="age", constant=3),
        NotNull(column="age"),
    )
    assert [(r[3], r[4]) for r in got] == [(2, 1), (2, 1), (3, 2), (3, 1)]


def test_nothing_evaluated(spark):
    df = spark.createDataFrame([], "age int")
    got = results(
        df,
        GreaterThan(column="age"),
        Equals(column="age", constant=3),
        AggregateBetween(column="age", min_value=0),
    )
    assert [(r[3], r[7]) for r in got] == [(0, True), (0, True), (0, False)]


@pytest.mark.parametrize(
    ("limits", "success"),
    [
        ({"min_value": 40}, True),
        ({"min_value": 40, "strict_min": True}, False),
        ({"max_value": 40}, True),
        ({"max_value": 40, "strict_max": True}, False),
        ({"min_value": 0, "max_value": 39.9}, False),
        ({"max_value": 7, "aggregate": "min"}, True),
        ({"min_value": 241, "aggregate": "sum"}, False),
        ({"min_value": 90, "aggregate": "max"}, True),
    ],
)
def test_aggregate_bounds(parcels, limits, success):
    assert results(parcels, AggregateBetween(column="weight", **limits))[0][7] is success


def test_aggregate_of_text(spark):
    df = spark.createDataFrame([("1",), ("3",), ("x",)], "v string")
    assert results(df, AggregateBetween(column="v", max_value=2))[0][6:] == (2.0, True)


@pytest.mark.parametrize(
    "make",
    [
        lambda: AggregateBetween(column="a"),
        lambda: AggregateBetween(column="a", min_value="1"),
        lambda: AggregateBetween(column="a", min_value=0, max_value=-1),
        lambda: AggregateBetween(column="a", min_value=1, strict_min="no"),
        lambda: AggregateBetween(column="a", min_value=1, aggregate="median"),
        lambda: GreaterThan(column="a", bound=None),
        lambda: NotNull(column="a", mostly=1.5),
        lambda: Between(column="a"),
    ],
)
def test_bad_arguments(make):
    with pytest.raises(ValueError):
        make()


@pytest.mark.parametrize(("limit", "success"), [(None, True), (0.3, True), (0.2, False)])
def test_stable_population(spark, limit, success):
    reference = [3.0, 7.0, 12.0, 15.0, 18.0, 25.0, 30.0, 60.0]
    current = [5.0, 12.0, 14.0, 16.0, 22.0, 28.0, 33.0, 35.0]
    df = spark.createDataFrame(
        [(v, "reference") for v in reference] + [(v, "current") for v in current],
        "minutes double, period string",
    )
    check = StablePopulation(
        column="minutes",
        period="period",
        splits=[0.0, 10.0, 20.0, 40.0, 80.0],
        baseline="reference",
        current="current",
        max_psi=limit,
    )
    row = results(df, NotNull(column="minutes"), check)[1]
    assert row[3] == 16
    assert row[6] == pytest.approx(0.375 * math.log(2))
    assert row[7] is success


def test_stable_population_open_ended(spark):
    df = spark.createDataFrame([(-5.0, "a"), (5.0, "a"), (5.0, "b"), (-5.0, "b")], "v double, p string")
    check = StablePopulation(
        column="v", period="p", splits=[0.0, 1.0], baseline="a", current="b", open_ended=True, max_psi=0.1
    )
    assert results(df, check)[0][6:] == (0.0, True)


def test_one_aggregation_for_the_whole_suite(parcels):
    checks = [NotNull(column="code"), GreaterThan(column="weight"), AggregateBetween(column="weight", min_value=1)]
    plan = run_checks(parcels, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    assert plan.count("Exchange") == 1
    with pytest.raises(ValueError):
        run_checks(parcels, [])


def test_many_bins_are_planned_quickly(spark):
    import time

    df = spark.range(2000).select((F.col("id") % 100).cast("double").alias("v"), F.when(F.col("id") < 900, "a").otherwise("b").alias("p"))
    splits = [float(x) for x in range(101)]
    check = StablePopulation(column="v", period="p", splits=splits, baseline="a", current="b")
    started = time.time()
    assert results(df, check)[0][6] == pytest.approx(0, abs=1e-6)
    assert time.time() - started < 30


def test_failing_rows(parcels, rows):
    assert rows(failing_rows(parcels, GreaterThan(column="weight", bound=30)), "weight") == [(12,), (7,)]
    assert rows(failing_rows(parcels, NotNull(column="code")), "weight") == [(7,)]
    nulls = parcels.withColumn("weight", F.lit(None).cast("int"))
    assert failing_rows(nulls, GreaterThan(column="weight")).count() == 0
    assert failing_rows(nulls, Equals(column="weight", constant=3)).count() == 6
