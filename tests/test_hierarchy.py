from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork.operators.hierarchy import ancestors, ancestors_by_role

#: Places and the place each lies in.
PLACES = [(1, None), (2, 1), (3, 1), (4, 2), (5, 4), (6, 5), (7, 5), (8, 3), (9, 3), (10, 2)]
KINDS = {1: "site", 2: "hall", 3: "hall", 4: "rack", 5: "rack"}


def edges(spark, data):
    return spark.createDataFrame(data, "inner int, outer int")


def test_ancestors_by_role(spark):
    kinds = spark.createDataFrame([(p, KINDS.get(p, "unit")) for p, _ in PLACES], "place int, kind string")
    pairs = ancestors(edges(spark, PLACES), "inner", "outer")
    wanted = ["rack", "hall", "site"]
    listed = ancestors_by_role(pairs, kinds, "place", "kind", wanted)
    assert listed.columns == ["place", *wanted]
    got = {r.place: tuple(r)[1:] for r in listed.collect()}
    expected = {1: ("", "", ""), 5: ("4", "2", "1")}
    expected |= dict.fromkeys((2, 3), ("", "", "1"))
    expected |= dict.fromkeys((4, 10), ("", "2", "1"))
    expected |= dict.fromkeys((6, 7), ("5;4", "2", "1"))
    expected |= dict.fromkeys((8, 9), ("", "3", "1"))
    assert got == expected
    again = ancestors_by_role(pairs, kinds, "place", "kind", wanted, rows_per_salt=1)
    assert {r.place: tuple(r)[1:] for r in again.collect()} == expected


def test_second_hierarchy(spark, rows):
    data = [(50, None), (51, 50), (52, 50), (53, 50), (54, 52), (55, 52), (56, 55)]
    pairs = ancestors(edges(spark, data), "inner", "outer")
    assert pairs.count() == 10
    assert pairs.agg(F.max("depth")).first()[0] == 3


def test_cycles_end(spark, rows):
    two = ancestors(edges(spark, [(1, 2), (2, 1)]), "inner", "outer")
    assert rows(two, "node", "ancestor") == [(1, 2), (2, 1)]
    tail = ancestors(edges(spark, [(1, 2), (2, 3), (3, 1), (4, 1), (5, 5)]), "inner", "outer")
    assert rows(tail) == [
        (1, 2, 1), (1, 3, 2), (2, 1, 2), (2, 3, 1), (3, 1, 1), (3, 2, 2),
        (4, 1, 1), (4, 2, 2), (4, 3, 3),
    ]


def test_long_chain(spark):
    chain = spark.range(1, 151).select("id", (F.col("id") - 1).alias("up"))
    pairs = ancestors(chain, "id", "up")
    assert pairs.count() == 150 * 151 // 2
    assert pairs.where("depth != node - ancestor").isEmpty()


def test_shortest_distance_with_two_parents(spark, rows):
    data = [(1, 2), (2, 3), (1, 3), (3, 4)]
    assert rows(ancestors(edges(spark, data), "inner", "outer")) == [
        (1, 2, 1), (1, 3, 1), (1, 4, 2), (2, 3, 1), (2, 4, 2), (3, 4, 1),
    ]


def test_salted_walk_equals_recursive_cte(spark, rows):
    tree = spark.range(1, 400).select("id", F.expr("id div 3").alias("up"))
    tree.createOrReplaceTempView("tree_edges")
    cte = spark.sql(
        """
        with recursive pairs(node, ancestor, depth) as (
            select id, up, 1 from tree_edges
            union all
            select p.node, e.up, p.depth + 1 from pairs p join tree_edges e on e.id = p.ancestor)
        select * from pairs
        """
    )
    assert rows(ancestors(tree, "id", "up", rows_per_salt=10)) == rows(cte)


def test_no_edges(spark):
    assert ancestors(edges(spark, [(1, None)]), "inner", "outer").count() == 0
