from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.joins import (
    enrich_details,
    fits_broadcast,
    hot_keys,
    join_groups,
    salted_join,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """10,000 rows, 90 % on one plan; some keys NULL, some unknown to the plans table."""
    plan = (
        F.when(F.col("id") % 10 != 0, 1)
        .when(F.col("id") % 50 == 0, None)
        .otherwise(F.col("id") % 90)
    )
    fact = spark.range(10_000).select("id", F.concat(F.lit("t"), "id").alias("phone"), plan.alias("plan"))
    dim = spark.range(40).select(
        F.col("id").alias("plan"), F.concat(F.lit("p"), "id").alias("name"), (F.col("id") % 3).alias("level")
    )
    return fact, dim


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hint", [None, "merge"])
def test_salted_join_equals_plain_join(skewed, rows, how, hint):
    fact, dim = skewed
    plain = rows(fact.join(dim, "plan", how), "id", "phone", "plan", "name", "level")
    every = salted_join(fact, dim, "plan", how, n_salts=7, hint=hint)
    assert every.columns == ["id", "phone", "plan", "name", "level"]
    assert rows(every) == plain
    hot = hot_keys(fact, "plan", rows_per_salt=100)
    assert rows(salted_join(fact, dim, "plan", how, hot=hot, hint=hint)) == plain
    by_id = salted_join(fact, dim, "plan", how, n_salts=7, salt_by=["id"], hint=hint)
    assert rows(by_id) == plain


def test_hot_key_is_spread_over_partitions(spark, skewed):
    fact, dim = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:

        def largest_part(hot_or_salts):
            joined = salted_join(fact, dim, "plan", hint="merge", **hot_or_salts)
            sizes = joined.groupBy(F.spark_partition_id().alias("p")).count()
            return sizes.agg(F.max("count")).first()[0]

        assert largest_part({"n_salts": 1}) >= 9000
        assert largest_part({"n_salts": 64}) < 3000
        assert largest_part({"hot": hot_keys(fact, "plan", rows_per_salt=100)}) < 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_keys_lists_only_hot_ones(skewed, rows):
    fact, _ = skewed
    assert rows(hot_keys(fact, "plan", rows_per_salt=1000)) == [(1, 9)]
    assert (None, 2) in rows(hot_keys(fact, "plan", rows_per_salt=100))
    assert hot_keys(fact, "plan").count() == 0
    assert hot_keys(fact, "id", rows_per_salt=0 + 1).count() == 0
    assert hot_keys(fact.limit(0), "plan", rows_per_salt=1).count() == 0


def test_salted_join_keeps_duplicate_dimension_rows(skewed, rows):
    fact, dim = skewed
    doubled = dim.unionAll(dim)
    plain = fact.join(doubled, "plan", "left").select("id", "phone", "plan", "name", "level")
    hot = hot_keys(fact, "plan", rows_per_salt=500)
    assert rows(salted_join(fact, doubled, "plan", hot=hot)) == rows(plain)


def test_a_key_listed_twice_does_not_multiply_rows(skewed, rows):
    fact, dim = skewed
    hot = hot_keys(fact, "plan", rows_per_salt=500)
    twice = hot.unionAll(hot.withColumn("_salts", F.col("_salts") + 1))
    plain = fact.join(dim, "plan", "left").select("id", "phone", "plan", "name", "level")
    assert rows(salted_join(fact, dim, "plan", hot=twice)) == rows(plain)


def test_a_long_list_of_hot_keys_is_not_broadcast(skewed, rows, monkeypatch):
    from tarnwork.operators import joins

    fact, dim = skewed
    monkeypatch.setattr(joins, "fits_broadcast", lambda table: False)
    hot = hot_keys(fact, "plan", rows_per_salt=100)
    plain = fact.join(dim, "plan", "left").select("id", "phone", "plan", "name", "level")
    assert rows(salted_join(fact, dim, "plan", hot=hot)) == rows(plain)


def test_salted_join_arguments(skewed):
    fact, dim = skewed
    with pytest.raises(ValueError):
        salted_join(fact, dim, "plan", how="fullouter", n_salts=2)
    with pytest.raises(ValueError):
        salted_join(fact, dim, "plan")
    with pytest.raises(ValueError):
        salted_join(fact, dim, "plan", n_salts=0)
    with pytest.raises(ValueError):
        salted_join(fact, dim.withColumn("phone", F.lit(1)), "plan", n_salts=2)


def test_salted_join_on_two_keys(spark, rows):
    fact = spark.range(500).select(F.lit(1).alias("a"), (F.col("id") % 3).alias("b"), "id")
    dim = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "a int, b long, c string")
    plain = fact.join(dim, ["a", "b"], "left").select("a", "b", "id", "c")
    hot = hot_keys(fact, ["a", "b"], rows_per_salt=20)
    assert rows(salted_join(fact, dim, ["a", "b"], hot=hot)) == rows(plain)


def test_join_groups_treats_null_as_a_group(skewed, rows):
    fact, _ = skewed
    counts = fact.groupBy("plan").agg(F.count(F.lit(1)).alias("n"))
    joined = join_groups(fact, counts, "plan", rows_per_salt=100)
    assert joined.count() == 10_000
    assert rows(joined.where("plan is null").select("n").distinct()) == [(200,)]


def test_enrich_details(spark, rows):
    orders = spark.createDataFrame(
        [(1, "c1"), (2, "c2"), (3, "c3")], "order_id smallint, customer_id string"
    )
    details = spark.createDataFrame(
        [("1", "9.5", "2", "0"), ("1", "1", "1", "0.1"), ("3", "7", "1", "0"), ("9", "1", "1", "0"),
         ("bad", "1", "1", "0"), (None, "1", "1", "0")],
        "order_id string, unit_price string, quantity string, discount string",
    )
    expected = [
        (1, "c1", "1", "1", "0.1"),
        (1, "c1", "9.5", "2", "0"),
        (3, "c3", "7", "1", "0"),
    ]
    assert rows(enrich_details(orders, details)) == expected
    keys = details.select(F.col("order_id").try_cast("smallint").alias("order_id"))
    hot = hot_keys(keys, "order_id", rows_per_salt=1)
    assert rows(enrich_details(orders, details, hot=hot)) == expected


def test_fits_broadcast_looks_at_rows_and_width(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
    assert fits_broadcast(df.limit(0), max_bytes=0)
