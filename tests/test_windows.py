from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnwork.operators.windows import _leaders, dominant_key, group_stats, max_rows, tied_keys

SCHEMA = "region string, dock long, home long, key long, value long"
VISITS = [
    ("north", 4, None, 12, 8),
    ("north", 4, None, 15, 3),
    ("north", 4, None, 19, 8),
    ("south", 4, 33, 31, 5),
    ("south", 4, None, 33, 2),
    ("east", 9, 22, 21, 7),
    ("east", 9, 22, 22, 7),
    ("east", 9, None, 25, 1),
]
GROUP = ["region", "dock"]


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(VISITS, SCHEMA)


def test_dominant_key(visits, rows):
    got = dominant_key(visits, GROUP, "key", "value", "home")
    assert rows(got) == [
        ("east", 9, 22, "incumbent"),
        ("north", 4, 12, "tie_break"),
        ("south", 4, 31, "unique"),
    ]


def test_dominant_key_incumbent_outside_the_tie_and_null_values(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 7, 1, 5), ("a", 1, None, 2, 5), ("b", 1, None, 1, None), (None, 1, None, 4, 2)],
        SCHEMA,
    )
    got = dominant_key(df, GROUP, "key", "value", "home")
    assert rows(got) == [("a", 1, 7, "incumbent"), (None, 1, 4, "unique")]


def test_max_rows(visits, rows):
    got = max_rows(visits, GROUP, "value")
    assert got.columns == visits.columns
    assert rows(got, "key") == [(12,), (19,), (21,), (22,), (31,)]
    assert rows(max_rows(visits, GROUP, "value", rows_per_salt=1)) == rows(got)


def test_tied_keys(spark, visits, rows):
    assert tied_keys(visits, GROUP, "key", "value").count() == 0
    assert rows(tied_keys(visits, GROUP, "key", "value", min_ties=2)) == [
        ("east", 9, 21),
        ("east", 9, 22),
        ("north", 4, 12),
        ("north", 4, 19),
    ]
    three = spark.createDataFrame([("a", 1, None, k, 5) for k in (1, 2, 3)] + [("a", 1, None, 9, 4)], SCHEMA)
    assert rows(tied_keys(three, GROUP, "key", "value"), "key") == [(1,), (2,), (3,)]


def test_group_stats_equals_windows(spark, visits, rows):
    wide = spark.range(5000).select(
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 30 == 0, None).otherwise(
            (F.col("id") % 17).cast("string")
        ).alias("region"),
        F.lit(1).cast("long").alias("dock"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("home"),
        F.col("id").alias("key"),
        (F.col("id") % 97).alias("value"),
    )
    for df in (visits, wide):
        whole = Window.partitionBy(*GROUP)
        equal = F.when(F.col("value") == F.col("max_value"), True)
        plain = (
            df.withColumn("max_value", F.max("value").over(whole))
            .withColumn("group_incumbent", F.max("home").over(whole))
            .withColumn("row_number", F.row_number().over(whole.orderBy("value", "key")).cast("long"))
            .withColumn("equal_count", F.count(equal).over(Window.partitionBy(*GROUP, "value")))
        )
        got = group_stats(df, GROUP, "key", "value", "home")
        assert got.columns == plain.columns
        assert rows(got) == rows(plain)


def test_a_hot_group_of_equal_rows_stays_spread(spark, rows):
    df = spark.range(0, 8000, 1, 8).select(F.lit("g").alias("region"), F.lit(1).alias("dock"), F.lit(5).alias("value"))
    assert max_rows(df, GROUP, "value", rows_per_salt=100).count() == 8000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        leaders = _leaders(df, GROUP, "value")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert leaders.count() == 8000 and len(leaders.inputFiles()) > 1  # written by several tasks


def test_leaders_are_chosen_before_the_shuffle(spark):
    df = spark.range(0, 8000, 1, 8).select((F.col("id") % 3).alias("g"), "id")
    inside = Window.partitionBy("g", "_part").orderBy(F.col("id").desc())
    ranked = df.withColumn("_part", F.spark_partition_id()).withColumn("_rank", F.rank().over(inside))
    plan = ranked.where("_rank = 1")._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("rank(id", plan.index("Exchange"))
    assert "Partial" in plan[partial : partial + 60]
    assert max_rows(df, "g", "id").count() == 3
