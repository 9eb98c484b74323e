"""Quantiles, multisets, grouping sets and streams."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.operators import cubes, multisets, quantiles
from tarnwork.operators.joins import join_groups
from tarnwork.scratch import scratch_path
from tarnwork.sources.versioned import latest_batch, read_version, versions
from tarnwork.streaming import state, windows


# --- quantiles ------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["discrete", "continuous"])
def test_quantiles_of_skewed_and_extreme_values(spark, kind):
    values = {
        None: [1.0] * 500, "a": [float(x) ** 3 for x in range(301)], "b": [-math.inf, 0.0, 1e-300, math.inf],
        "c": [7.0], "d": [math.nan, None], "e": [1.0 + k * 2.0**-52 for k in range(9)] * 3,
    }
    rows = [(k, v) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {(r["k"], r["prob"]): r["quantile"] for r in quantiles.quantiles(df, "k", "v", probs, kind).collect()}
    method = {"discrete": "inverted_cdf", "continuous": "linear"}[kind]
    for key in (None, "a", "c", "e"):
        for p in probs:
            assert got[key, p] == pytest.approx(np.quantile(values[key], p, method=method), rel=1e-12)
    assert "d" not in {k for k, _ in got}
    if kind == "discrete":
        assert [got["b", p] for p in probs] == [-math.inf, -math.inf, 0.0, math.inf, math.inf]


def test_quantiles_of_large_whole_numbers_are_exact(spark):
    values = [-(2**63), -1, 2**62, 2**62 + 1, 2**62 + 3, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = quantiles.quantiles(df, [], "v", [k / 6 for k in range(1, 7)]).orderBy("prob").collect()
    assert [r["quantile"] for r in got] == values


def test_no_values_have_no_quantiles(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert quantiles.quantiles(none, "k", "v", [0.5]).collect() == []
    with pytest.raises(ValueError):
        quantiles.quantiles(none, "k", "k", [0.5])


# --- multisets --------------------------------------------------------------------------


def test_multisets_count_copies(spark):
    one = [("a", 1)] * 5 + [("b", None)] * 2 + [(None, None)] * 3 + [("c", 3)]
    two = [("a", 1)] * 2 + [("b", None)] * 4 + [(None, None)] * 3 + [("d", 4)]
    left, right = (spark.createDataFrame(rows, "k string, v int") for rows in (one, two))
    a, b = Counter(one), Counter(two)
    expected = {
        multisets.intersect_all: a & b, multisets.except_all: a - b,
        multisets.symmetric_difference: (a - b) + (b - a),
    }
    for operator, want in expected.items():
        for chunk in (2, 100_000):
            assert Counter(tuple(r) for r in operator(left, right, chunk).collect()) == want
    empty = left.limit(0)
    assert multisets.intersect_all(left, empty).collect() == []
    with pytest.raises(ValueError):
        multisets.except_all(left, right.select("v", "k"))


def test_a_million_copies_are_written_by_several_tasks(spark):
    many = spark.range(1_000_000).select(F.lit(7).alias("v"))
    few = spark.range(10).select(F.lit(7).alias("v"))
    left = multisets.except_all(many, few)
    sizes = left.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 999_990
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 999_990


def test_equal_rows_of_a_hot_group_get_several_salts(spark, monkeypatch):
    from tarnwork.operators import joins

    rows = spark.createDataFrame([("hot", 1)] * 1000 + [("cold", 2)], "k string, v int").repartition(8)
    groups = spark.createDataFrame([("hot", 10), ("cold", 20)], "k string, g int")
    salts = []
    plain = joins.salted_join

    def watched(fact, dim, on, how, hot, salt_by, null_safe):
        salts.append(fact.where("k = 'hot'").select(F.pmod(F.xxhash64(*salt_by), F.lit(10))).distinct().count())
        return plain(fact, dim, on, how, hot=hot, salt_by=salt_by, null_safe=null_safe)

    monkeypatch.setattr(joins, "salted_join", watched)
    joined = join_groups(rows, groups, "k", rows_per_salt=100)
    assert joined.columns == ["k", "v", "g"] and joined.count() == 1001
    assert salts[0] > 1


# --- grouping sets ----------------------------------------------------------------------


def test_grouping_sets_tell_null_from_not_grouped(spark):
    rows = [("a", None, 1, -5), ("a", "x", 2, 40_000), (None, "x", 3, 40_000), (None, None, None, None), ("a", "x", 2, 7)]
    df = spark.createDataFrame(rows, "p string, q string, v int, w int")
    measures = {"n": ("count", None), "n_v": ("count", "v"), "s": ("sum", "v"), "hi": ("max", "v")}
    got = cubes.grouping_sets(df, cubes.cube_sets(["p", "q"]), measures, distinct=("d", "w"))
    df.createOrReplaceTempView("cube_rows")
    expected = spark.sql(
        "select p, q, cast(grouping_id(p, q) as int) as grouping, count(*) as n, count(v) as n_v, "
        "sum(v) as s, max(v) as hi, count(distinct w) as d from cube_rows group by cube (p, q)"
    )
    plain = lambda x: sorted((tuple(r) for r in x.collect()), key=repr)
    assert plain(got) == plain(expected)
    total = cubes.grouping_sets(df.limit(0), [("p",), ()], measures, distinct=("d", "w")).collect()
    assert [tuple(r) for r in total] == [(None, 1, 0, 0, None, None, 0)]


# --- streams ----------------------------------------------------------------------------


def _write(spark, folder, rows):
    spark.createDataFrame(rows, "k string, at timestamp_ntz, v int").coalesce(1).write.mode("append").parquet(folder)


def _minute(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


def test_late_rows_are_dropped_and_a_later_run_goes_on(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = windows.read_file_stream(spark, folder, "k string, at timestamp_ntz, v int")
        new = {"n": F.count(F.lit(1)), "v": F.sum("v")}
        found = windows.windowed(stream, "at", "10 minutes", "5 minutes", new, keys="k")
        windows.run_available(found, out, checkpoint)
        stored = spark.read.schema(found.schema).parquet(out)
        return sorted((r["k"], r["window_start"], r["window_end"], r["n"], r["v"]) for r in stored.collect())

    _write(spark, folder, [("a", _minute(1), 1), ("a", _minute(9), 2), ("b", _minute(12), 4), ("a", None, 9)])
    assert run() == []  # the watermark stands at minute 7
    _write(spark, folder, [("a", _minute(8), 8), ("b", _minute(26), 1)])  # late, but the window is open
    first = [("a", _minute(0), _minute(10), 3, 11), ("b", _minute(10), _minute(20), 1, 4)]
    assert run() == first
    assert run() == first  # nothing new, nothing twice
    _write(spark, folder, [("a", _minute(3), 100), ("b", _minute(41), 1)])  # too late: dropped
    assert run() == [*first, ("b", _minute(20), _minute(30), 1, 1)]


def test_sliding_windows_over_a_batch(spark):
    rows = [("a", _minute(1), 1), ("a", _minute(7), 2)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, v int")
    got = windows.windowed(df, "at", "10 minutes", "0 seconds", {"v": F.sum("v")}, slide="5 minutes")
    assert sorted((r["window_start"], r["v"]) for r in got.collect()) == [
        (_minute(-5), 1), (_minute(0), 3), (_minute(5), 2),
    ]


def test_a_replayed_batch_changes_nothing(spark):
    path = scratch_path(spark, "state")
    schema = "k string, t int, v string"
    one = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 1, "z"), (None, 1, "n")], schema)
    two = spark.createDataFrame([("a", 2, "late"), ("b", 5, "new")], schema)
    assert state.apply_batch(one, 0, path, "k", "t")
    assert state.apply_batch(two, 1, path, "k", "t")
    want = [("a", 3, "y"), ("b", 5, "new"), (None, 1, "n")]
    read = lambda: sorted((tuple(r) for r in read_version(spark, path).collect()), key=repr)
    assert read() == sorted(want, key=repr)
    assert not state.apply_batch(two, 1, path, "k", "t") and not state.apply_batch(one, 0, path, "k", "t")
    assert read() == sorted(want, key=repr)
    assert versions(spark, path) == [0, 1] and latest_batch(spark, path) == 1


def test_state_goes_on_from_the_checkpoint(spark):
    folder, path, checkpoint = (scratch_path(spark, n) for n in ("in", "state", "checkpoint"))

    def run():
        stream = windows.read_file_stream(spark, folder, "k string, at timestamp_ntz, v int", files_per_batch=1)
        state.keep_latest(stream, path, checkpoint, "k", "at")
        return sorted((r["k"], r["v"]) for r in read_version(spark, path).collect())

    _write(spark, folder, [("a", _minute(1), 1), ("b", _minute(1), 2)])
    _write(spark, folder, [("a", _minute(5), 3)])
    assert run() == [("a", 3), ("b", 2)]
    _write(spark, folder, [("a", _minute(4), 9), ("b", _minute(9), 4)])
    assert run() == [("a", 3), ("b", 4)]
    assert latest_batch(spark, path) == 2
