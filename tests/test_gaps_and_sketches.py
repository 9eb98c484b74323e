"""Filled series and stored sketches."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnwork.operators import gaps, sketches
from tarnwork.operators.gaps import fill_gaps
from tarnwork.scratch import scratch_path

START = dt.datetime(1970, 1, 1)


@pytest.fixture
def measures(spark):
    return {
        "n": (F.count("v"), "zero"), "cost": (F.sum("d"), "zero"),
        "last": (F.max("v"), "previous"), "level": (F.max("v"), "linear"),
    }


def brute_fill(rows, step):
    slots = defaultdict(lambda: defaultdict(list))
    for key, at, v, d in rows:
        if at is not None:
            slots[key][(at - START) // dt.timedelta(seconds=step)].append((v, d))
    out = []
    for key, found in slots.items():
        known = sorted(found)
        top = {s: max((v for v, _ in found[s] if v is not None), default=None) for s in known}
        for a, b in zip(known, [*known[1:], None]):
            costs = [d for _, d in found[a] if d is not None]
            level = None if top[a] is None else float(top[a])
            n = sum(v is not None for v, _ in found[a])
            out.append((key, a, n, sum(costs) if costs else None, top[a], level, False))
            for s in range(a + 1, b or 0):
                between = None
                if top[a] is not None and top[b] is not None:
                    between = top[a] + float(top[b] - top[a]) * (s - a) / (b - a)
                out.append((key, s, 0, 0.0, top[a], between, True))
    return sorted(((k, START + dt.timedelta(seconds=s * step), *m) for k, s, *m in out), key=repr)


@pytest.mark.parametrize("chunk_slots", [1, 7, 4096])
def test_gaps_are_filled_as_by_hand(spark, rows, measures, chunk_slots):
    draw = random.Random(chunk_slots)
    seconds = lambda: dt.timedelta(seconds=draw.uniform(-30_000, 60_000))
    made = [
        (draw.choice(["a", "a", "a", "b", None]), START + seconds(), draw.choice([None, 1, 5, 90]), draw.choice([None, 0.5, 2.25]))
        for _ in range(150)
    ]
    made += [("one", START, 3, None), ("none", None, 3, 1.0), ("far", START, 1, 1.0), ("far", START + dt.timedelta(days=3), 4, 0.0)]
    df = spark.createDataFrame(made + made[:5], "k string, at timestamp_ntz, v int, d double")
    out = fill_gaps(df, "k", "at", 600, measures, chunk_slots)
    assert out.columns == ["k", "at", "n", "cost", "last", "level", "filled"]
    assert dict(out.dtypes)["at"] == "timestamp_ntz" and dict(out.dtypes)["n"] == "bigint"
    assert rows(out) == brute_fill(made + made[:5], 600)


def test_a_hot_key_and_a_long_gap_are_many_tasks(spark, measures):
    rows = [("hot", START + dt.timedelta(seconds=s), 1, 1.0) for s in range(3000)]
    rows += [("gap", START, 0, 0.0), ("gap", START + dt.timedelta(seconds=3000), 3000, 0.0)]
    df = spark.createDataFrame(rows, "k string, at timestamp, v int, d double")
    out = fill_gaps(df, "k", "at", 1, measures, 100).withColumn("task", F.spark_partition_id())
    found = out.groupBy("k").agg(
        F.count("*").alias("n"), F.countDistinct("task").alias("tasks"), F.sum("level").alias("level")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would fit in one task
    try:
        got = {r["k"]: (r["n"], r["tasks"] > 1, r["level"]) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {"hot": (3000, True, 3000.0), "gap": (3001, True, sum(range(3001)))}
    assert dict(out.dtypes)["at"] == "timestamp"


def test_gaps_of_nothing_and_wrong_arguments(spark, measures):
    df = spark.createDataFrame([], "k string, q int, at timestamp_ntz, v int, d double")
    assert fill_gaps(df, ["k", "q"], "at", 60, measures).collect() == []
    for wrong in ({}, {"n": (F.count("v"), "next")}, {"k": (F.count("v"), "zero")}):
        with pytest.raises(ValueError):
            fill_gaps(df, "k", "at", 60, wrong)
    with pytest.raises(ValueError):
        fill_gaps(df, "k", "at", 0, measures)
    with pytest.raises(Exception, match="is not a number"):
        fill_gaps(df, "q", "at", 60, {"x": (F.max("k"), "linear")})


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_one_batch_fills_many_chunks_in_batches_of_bounded_size(monkeypatch, size):
    monkeypatch.setattr(gaps, "BATCH_SLOTS", size)

    class Tens(gaps.FillSlots):
        fills, chunk_slots = ("zero", "previous", "linear"), 10

    follows = pa.struct([("_slot", pa.int64()), ("level", pa.float64())])
    given = [
        ("a", 0, 8, 5, "x", 1.0, {"_slot": 12, "level": 3.0}),
        ("a", 0, 12, 7, "y", 3.0, None),  # only looked at
        (None, 1, 7, 1, "p", 2.0, {"_slot": 25, "level": None}),  # no row of its own in the chunk
        ("a", 1, 12, 7, "y", 3.0, None),
        ("a", 1, 8, 5, "x", 1.0, {"_slot": 12, "level": 3.0}),  # in any order
    ]
    names = ["k", "_chunk", "_slot", "n", "last", "level", "_next"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float64(), follows]
    columns = [pa.array(c, t) for c, t in zip(zip(*given), types)]
    found = list(Tens().eval(pa.RecordBatch.from_arrays(columns, names=names)))
    assert {b.num_rows for b in found[:-1]} <= {size} and 0 < found[-1].num_rows <= size
    assert found[0].schema.names == ["k", "_slot", "n", "last", "level", "filled"]
    expected = [("a", 8, 5, "x", 1.0, False), ("a", 9, 0, "x", 1.5, True)]
    expected += [(None, s, 0, "p", None, True) for s in range(10, 20)]
    expected += [("a", 12, 7, "y", 3.0, False), ("a", 10, 0, "x", 2.0, True), ("a", 11, 0, "x", 2.5, True)]
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == expected


def test_gaps_of_many_types_are_filled_in_arrow_batches(spark, rows):
    day = lambda d, **more: dt.datetime(2024, 3, d, **more)
    made = [(b"k", day(30, hour=22), day(1), 1.5, 7, "a"), (b"k", day(31, hour=4), None, 2.0, 9, "b"), (None, day(31), day(2), None, None, None)]
    df = spark.createDataFrame(made, "k binary, at timestamp, t timestamp, d double, i tinyint, s string")
    df = df.withColumn("d", F.col("d").cast("decimal(12,3)"))
    measures = {
        "cost": (F.sum("d"), "zero"), "i": (F.max("i"), "zero"), "f": (F.max(F.col("i").cast("float")), "zero"),
        "t": (F.max("t"), "previous"), "all": (F.collect_list(F.struct("s", "d")), "previous"), "level": (F.max("d"), "linear"),
    }
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        out = fill_gaps(df, "k", "at", 7200, measures, 2)
        assert "ArrowEvalPythonUDTF" in out._jdf.queryExecution().executedPlan().toString()
        kinds = dict(out.dtypes)
        got = rows(out.withColumns({"k": F.hex("k"), "at": F.unix_seconds("at"), "t": F.unix_seconds("t")}))
        (start, t), _, (other, u) = df.select(F.unix_seconds("at"), F.unix_seconds("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (kinds["cost"], kinds["i"], kinds["f"], kinds["t"]) == ("decimal(22,3)", "tinyint", "float", "timestamp")
    none, first, last = Decimal("0.000"), Decimal("1.500"), Decimal("2.000")
    expected = [("6B", start, first, 7, 7.0, t, [("a", first)], 1.5, False)]
    expected += [("6B", start + 7200 * n, none, 0, 0.0, t, [("a", first)], 1.5 + 0.5 * n / 3, True) for n in (1, 2)]
    expected += [("6B", start + 7200 * 3, last, 9, 9.0, None, [("b", last)], 2.0, False)]
    expected += [(None, other, None, None, None, u, [(None, None)], None, False)]
    assert [(*r[:6], [tuple(x) for x in r[6]], *r[7:]) for r in got] == sorted(expected, key=repr)


def _stored(spark, path):
    return sketches.read_sketches(spark, path, "month string, k string")


def test_sketches_of_a_hot_group_stay_within_their_error(spark):
    n = 200_000
    df = spark.range(n, numPartitions=8).select(
        F.format_string("%02d", F.col("id") % 3 + 1).alias("month"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
        (F.col("id") % 50_000).alias("user"), (F.col("id") * 7919 % n).cast("double").alias("v"),
    )
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(df, path, "month", "k", distinct={"u": "user"}, quantile={"v": "v"}, sums={"v": "v"})
    probs = (0.0, 0.1, 0.5, 0.99, 1.0)
    got = sketches.estimates(sketches.merge_sketches(_stored(spark, path), "k"), probs).collect()
    values = defaultdict(list)
    for r in df.select("k", "user", "v").collect():
        values[r["k"]].append((r["user"], r["v"]))
    assert {r["k"] for r in got} == set(values)
    for r in got:
        users, numbers = {u for u, _ in values[r["k"]]}, sorted(v for _, v in values[r["k"]])
        assert r["n_rows"] == len(numbers) and r["sum_v"] == sum(numbers)
        assert abs(r["distinct_u"] - len(users)) <= 4 * sketches.distinct_error() * len(users)
        for p, q in zip(probs, r["quantile_v"]):
            below, upto = (sum(v < q for v in numbers), sum(v <= q for v in numbers))
            off = 2 * sketches.rank_error()
            assert below / len(numbers) <= p + off and upto / len(numbers) >= p - off
    plan = sketches.sketch_rows(df, ["month", "k"], distinct={"u": "user"})._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan  # combined before the shuffle


def test_a_period_stored_again_counts_nothing_twice(spark, rows):
    schema = "month string, k string, u int, v double"
    first = spark.createDataFrame(
        [("01", "a", 1, 1.0), ("01", "a", 2, 2.0), ("02", "a", 2, 4.0), ("02", None, None, None), ("02", "n", 1, float("nan"))], schema
    )
    path = scratch_path(spark, "sketches")
    measures = {"distinct": {"u": "u"}, "quantile": {"v": "v"}, "sums": {"v": "v"}}
    sketches.store_sketches(first, path, "month", "k", **measures)
    late = spark.createDataFrame([("01", "a", 1, 1.0), ("01", "a", 2, 2.0), ("01", "a", 3, 9.0)], schema)
    for _ in range(2):
        sketches.store_sketches(late, path, "month", "k", **measures)
    stored = _stored(spark, path)
    assert rows(stored, "month", "n_rows") == [("01", 3), ("02", 1), ("02", 1), ("02", 1)]
    of = {r["k"]: r for r in sketches.estimates(sketches.merge_sketches(stored, "k"), (0, 1)).collect()}
    assert (of["a"]["n_rows"], of["a"]["distinct_u"], of["a"]["sum_v"], of["a"]["quantile_v"]) == (4, 3, 16.0, [1.0, 9.0])
    assert (of[None]["n_rows"], of[None]["distinct_u"], of[None]["sum_v"], of[None]["quantile_v"]) == (1, 0, None, None)
    assert of["n"]["quantile_v"] is None and of["n"]["distinct_u"] == 1
    one = sketches.estimates(sketches.merge_sketches(stored.where("month = '01'"))).collect()
    assert [(r["n_rows"], r["distinct_u"], r["quantile_v"]) for r in one] == [(3, 3, [2.0])]
    assert "PartitionFilters: [isnotnull(month" in stored.where("month = '01'")._jdf.queryExecution().executedPlan().toString()
    none = sketches.estimates(sketches.merge_sketches(stored.where("month = '09'"))).collect()
    assert [(r["n_rows"], r["distinct_u"], r["sum_v"], r["quantile_v"]) for r in none] == [(0, 0, None, None)]


def test_sketches_refuse_what_they_cannot_answer(spark):
    path = scratch_path(spark, "sketches")
    df = spark.createDataFrame([("01", 1.0)], "month string, v double")
    sketches.store_sketches(df, path, "month", quantile={"v": "v"})
    with pytest.raises(ValueError, match="has no column day"):
        sketches.read_sketches(spark, path, "day string")
    with pytest.raises(ValueError, match="between 0 and 1"):
        sketches.estimates(sketches.read_sketches(spark, path, "month string"), (1.5,))
