"""Joins on inequalities against plain loops and DuckDB."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tarnwork.operators import ranges


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def spans(spark):
    draw = random.Random(1)
    rows = []
    for i in range(300):
        start = draw.choice([None, *range(-50, 200)])
        length = draw.choice([0, 1, 2, 3, 40, 900, -5])
        rows.append((draw.choice([None, "a", "a", "b"]), i, start, None if start is None else start + length))
    return rows


def overlapping(one, two, keyed):
    return sorted(
        (
            (*a, *(b[1:] if keyed else b))
            for a in one for b in two
            if None not in (*a[2:], *b[-2:]) and (not keyed or (a[0] is not None and a[0] == b[0]))
            and a[2] <= a[3] and b[-2] <= b[-1] and a[2] <= b[-1] and b[-2] <= a[3]
        ),
        key=repr,
    )


@pytest.mark.parametrize("width", [None, 0.5, 64, 5000])
@pytest.mark.parametrize("rows_per_salt", [20, 5_000_000])
def test_interval_join(spark, spans, width, rows_per_salt):
    left = spark.createDataFrame(spans, "k string, i int, s int, e int")
    right = spark.createDataFrame(spans[::2], "k string, ri int, rs int, re int")
    got = ranges.interval_join(
        left, right, ("s", "e"), ("rs", "re"), on="k", width=width, rows_per_salt=rows_per_salt
    )
    assert found(got) == overlapping(spans, spans[::2], True)


def test_interval_join_without_keys_of_times(spark, spans):
    day = dt.datetime(2024, 3, 30)  # around a change of the clock in many zones
    at = lambda x: None if x is None else day + dt.timedelta(hours=x)
    rows = [(i, at(s), at(e)) for _, i, s, e in spans[:120]]
    left = spark.createDataFrame(rows, "i int, s timestamp_ntz, e timestamp_ntz")
    right = left.toDF("ri", "rs", "re")
    expected = overlapping([(0, *r) for r in rows], [(0, *r) for r in rows], False)
    got = ranges.interval_join(left, right, ("s", "e"), ("rs", "re"))
    assert found(got) == sorted(((*x[1:4], *x[5:]) for x in expected), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_copies_in_a_hot_bin_are_salted(spark, monkeypatch):
    """Exact copies of one span are dealt to several salts, and all pairs come out."""
    left = spark.createDataFrame([("a", 1, 2)] * 500, "k string, s int, e int")
    right = spark.createDataFrame([("a", 2, 9), ("a", 3, 9)], "k string, rs int, re int")
    seen = []
    plain = ranges.salted_join

    def watched(fact, dim, on, how, hot, salt_by):
        salts = fact.select(F.pmod(F.xxhash64(*salt_by), F.lit(10))).distinct().count()
        seen.append((salts, hot.agg(F.max("_salts")).first()[0]))
        return plain(fact, dim, on, how, hot=hot, salt_by=salt_by)

    monkeypatch.setattr(ranges, "salted_join", watched)
    got = ranges.interval_join(left, right, ("s", "e"), ("rs", "re"), on="k", rows_per_salt=50)
    assert got.count() == 500
    assert seen[0][0] == 10 and seen[0][1] >= 10


@pytest.mark.parametrize("first, second", [("<", ">="), (">=", "<"), (">", ">"), ("<=", "<=")])
@pytest.mark.parametrize("keys, n", [("k", 1), ("k", 6), ((), 6)])
def test_counts_under_two_inequalities(spark, first, second, keys, n):
    draw = random.Random(2)
    rows = [(draw.choice([None, "a", "a", "b"]), draw.choice([None, *range(20)]), draw.randint(0, 9)) for _ in range(200)]
    left = spark.createDataFrame(rows, "k string, x int, y int")
    right = spark.createDataFrame(rows[50:], "k string, rx int, ry int")
    ops = {"<": int.__lt__, "<=": int.__le__, ">": int.__gt__, ">=": int.__ge__}
    expected = [
        (k, x, y, sum(
            (not keys or (k is not None and k == rk)) and None not in (x, rx)
            and ops[first](rx, x) and ops[second](ry, y) for rk, rx, ry in rows[50:]
        ))
        for k, x, y in rows
    ]
    got = ranges.count_both(left, right, ("rx", first, "x"), ("ry", second, "y"), on=keys, n_pieces=n)
    assert found(got) == sorted(expected, key=repr)


def test_counting_sorts_far_fewer_rows_than_there_are_pairs(spark, monkeypatch):
    """Work is rows times levels of the tree, also where all rows are equal in the first column."""
    rows = [(7, i % 50) for i in range(2000)]
    df = spark.createDataFrame(rows, "x int, y int")
    sorted_rows = []
    plain = ranges.running_totals

    def watched(nodes, *args, **kwargs):
        sorted_rows.append(nodes.count())
        return plain(nodes, *args, **kwargs)

    monkeypatch.setattr(ranges, "running_totals", watched)
    got = ranges.count_both(df, df, ("x", "<=", "x"), ("y", "<", "y"), n_pieces=5)
    assert found(got) == sorted(((7, y, 40 * y) for _, y in rows), key=repr)
    assert sorted_rows[0] <= 3 * 4000 < 2000 * 2000 / 100


def test_odd_inputs(spark):
    none = spark.createDataFrame([], "k string, s int, e int")
    some = spark.createDataFrame([("a", 1, 2)], "k string, rs int, re int")
    assert ranges.interval_join(none, some, ("s", "e"), ("rs", "re"), on="k").collect() == []
    assert ranges.interval_join(some, none, ("rs", "re"), ("s", "e"), on="k").collect() == []
    assert found(ranges.count_both(some, none, ("s", "<", "rs"), ("e", "<", "re"), on="k")) == [("a", 1, 2, 0)]
    assert ranges.count_both(none, some, ("rs", "<", "s"), ("re", "<", "e")).collect() == []
    with pytest.raises(ValueError):
        ranges.interval_join(some, some, ("rs", "re"), ("rs", "re"), on="k")
    with pytest.raises(ValueError):
        ranges.count_both(some, some, ("rs", "!=", "rs"), ("re", "<", "re"))


def test_rows_are_dealt_out_twice_however_many_levels(spark, monkeypatch):
    """between pieces only a table of pieces and bands is summed up, not all rows per level."""
    draw = random.Random(3)
    rows = [(draw.uniform(0, 9), draw.randint(0, 400)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "x double, y int")
    summed = []
    plain = ranges.running_totals

    def watched(cells, *args, **kwargs):
        summed.append(cells.count())
        return plain(cells, *args, **kwargs)

    monkeypatch.setattr(ranges, "running_totals", watched)
    got = ranges.count_both(df, df, ("x", "<", "x"), ("y", ">", "y"), n_pieces=3)
    assert found(got) == sorted(((x, y, sum(a < x and b > y for a, b in rows)) for x, y in rows), key=repr)
    assert summed and max(summed) <= 3 * 3
