"""Ordered operators against DuckDB, over several pieces, with a key that holds most rows."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tarnwork.operators import ordered

#: More pieces than keys.
PIECES = [7]


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(0)
    rows = [
        (draw.choice([None, "a", "a", "a", "b", "c"]), draw.choice([None, *range(30)]), i, draw.randint(0, 9))
        for i in range(400)
    ]
    database = duckdb.connect()
    database.execute("create table d (k varchar, t int, i int, v int)")
    database.executemany("insert into d values (?, ?, ?, ?)", rows)

    def sql(text):
        return sorted((tuple(r) for r in database.execute(text).fetchall()), key=repr)

    df = spark.createDataFrame(rows, "k string, t int, i int, v int")
    return df, sql


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", PIECES)
def test_running_totals(table, n):
    df, sql = table
    got = ordered.running_totals(df, "k", ["t", "i"], {"c": F.col("v"), "n": F.lit(1)}, n_pieces=n)
    assert found(got) == sql(
        "select *, sum(v) over w, count(*) over w from d "
        "window w as (partition by k order by t nulls first, i rows unbounded preceding)"
    )
    got = ordered.running_totals(df, [], [F.col("t").desc(), "i"], {"c": F.col("v")}, include_row=False, n_pieces=n)
    assert found(got) == sql(
        "select *, coalesce(sum(v) over (order by t desc nulls last, i "
        "rows between unbounded preceding and 1 preceding), 0) from d"
    )


@pytest.mark.parametrize("n", [1, 40])
@pytest.mark.parametrize("column", ["t", "v"])
def test_ranks_of_ties_longer_than_a_piece(table, n, column):
    df, sql = table
    got = ordered.ranks(df, "k", column, n_pieces=n).select("i", "rank", "dense_rank", "n_rows")
    assert found(got) == sql(
        "select i, rank() over w, dense_rank() over w, count(*) over (partition by k) from d "
        f"window w as (partition by k order by {column} nulls first)"
    )


@pytest.mark.parametrize("n", PIECES)
@pytest.mark.parametrize("tiles", [1, 7, 500])
def test_tiles(table, n, tiles):
    df, sql = table
    got = ordered.ranks(df, "k", ["t", "i"], tiles=tiles, n_pieces=n).select("i", "row_number", "tile")
    assert found(got) == sql(
        f"select i, row_number() over w, ntile({tiles}) over w from d "
        "window w as (partition by k order by t nulls first, i)"
    )


@pytest.mark.parametrize("n", PIECES)
@pytest.mark.parametrize("a, b", [(3, 2), (0, 0), (150, 0), (0, 90)])
def test_frames_by_rows(table, n, a, b):
    df, sql = table
    new = {"c": F.sum("v"), "m": F.max("t")}
    assert found(ordered.sliding(df, "k", ["t", "i"], new, rows=(a, b), n_pieces=n)) == sql(
        "select *, sum(v) over w, max(t) over w from d window w as (partition by k "
        f"order by t nulls first, i rows between {a} preceding and {b} following)"
    )


@pytest.mark.parametrize("n", PIECES)
@pytest.mark.parametrize("x, y", [(3, 2), (0, 0), (20, 1)])
def test_frames_by_values(table, n, x, y):
    df, sql = table
    new = {"c": F.sum("v"), "m": F.count("v")}
    assert found(ordered.sliding(df, "k", "t", new, values=(x, y), n_pieces=n)) == sql(
        "select *, case when t is not null then sum(v) over w end, "
        "case when t is not null then count(v) over w end from d window w as "
        f"(partition by k order by t range between {x} preceding and {y} following)"
    )


@pytest.mark.parametrize("n", PIECES)
def test_neighbours_beyond_the_next_piece(table, n):
    df, sql = table
    new = {"a": ("v", -1), "b": ("i", 2), "z": ("i", -140)}
    assert found(ordered.neighbours(df, "k", ["t", "i"], new, n_pieces=n)) == sql(
        "select *, lag(v) over w, lead(i, 2) over w, lag(i, 140) over w from d "
        "window w as (partition by k order by t nulls first, i)"
    )


@pytest.mark.parametrize("n", [1, 40])
@pytest.mark.parametrize("gap", [0, 1])
def test_sessions_over_borders(table, n, gap):
    df, sql = table
    some = df.where("i % 5 > 1 or k <> 'a'")
    got = ordered.sessions(some, "k", "t", F.lit(gap), {"s": F.col("v")}, n_pieces=n)
    assert found(got) == sql(
        "with a as (select *, case when t - lag(t) over (partition by k order by t, i) "
        f"<= {gap} then 0 else 1 end as o from d where t is not null and (i % 5 > 1 or k <> 'a')), "
        "b as (select *, sum(o) over (partition by k order by t, i rows unbounded preceding) as s from a) "
        "select k, min(t), max(t), count(*), sum(v) from b group by k, s"
    )


@pytest.mark.parametrize("n", PIECES)
@pytest.mark.parametrize("direction, op, best", [("backward", "<", "max"), ("forward", ">", "min")])
@pytest.mark.parametrize("equal", [True, False])
def test_asof_join(table, n, direction, op, best, equal):
    df, sql = table
    right = df.select("k", F.col("t").alias("rt"), F.col("i").alias("ri"))
    got = ordered.asof_join(
        df.where("i % 3 = 0"), right, "k", "t", "rt", direction=direction, allow_equal=equal, n_pieces=n
    )
    assert found(got) == sql(
        f"with m as (select l.i, {best}(r.t) as rt from d l join d r on l.k = r.k "
        f"and r.t {op}{'=' if equal else ''} l.t where l.i % 3 = 0 group by l.i) "
        "select d.*, rt, (select max(x.i) from d x where x.k = d.k and x.t = rt) "
        "from d left join m using (i) where d.i % 3 = 0"
    )


def test_asof_join_within_a_tolerance_and_inner(table):
    df, sql = table
    left, right = df.where("i % 9 = 0"), df.where("i % 40 = 1").select("k", F.col("t").alias("rt"))
    near = ordered.asof_join(left, right, "k", "t", "rt", tolerance=F.lit(4), how="inner", n_pieces=5)
    assert found(near) == sql(
        "select l.*, max(r.t) from d l join d r on l.k = r.k and r.t <= l.t and l.i % 9 = 0 and r.i % 40 = 1 "
        "group by all having max(r.t) >= l.t - 4"
    )
    with pytest.raises(ValueError):
        ordered.asof_join(df, df, "k", "t", "t")


def test_nothing_in_nothing_out(spark):
    none = spark.createDataFrame([], "k string, t int, v int")
    other = none.select("k", F.col("t").alias("rt"))
    assert ordered.asof_join(none, other, "k", "t", "rt").collect() == []
    assert ordered.ranks(none, "k", "t", tiles=3).collect() == []
    assert ordered.sliding(none, "k", "t", {"s": F.sum("v")}, values=(1, 1)).collect() == []
    assert ordered.sessions(none, "k", "t", F.lit(1)).collect() == []
    assert ordered.running_totals(none, "k", "t", {"s": F.col("v")}).collect() == []


def test_equal_rows_of_one_key_stand_in_several_pieces(spark):
    copies = spark.createDataFrame([("hot", 1, 2)] * 3000 + [("cold", 1, 1)], "k string, t int, v int")
    pieces = ordered.Pieces(copies, ["k"], ["t"], 6)
    sizes = pieces.rows.where("k = 'hot'").groupBy("_o_piece").count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 1000
    got = ordered.running_totals(copies, "k", "t", {"s": F.col("v")}, n_pieces=6)
    assert sorted(r.s for r in got.where("k = 'hot'").collect()) == list(range(2, 6001, 2))
    ranked = ordered.ranks(copies, "k", "t", n_pieces=6).where("k = 'hot'")
    assert {(r["rank"], r["dense_rank"], r["n_rows"]) for r in ranked.collect()} == {(1, 1, 3000)}
