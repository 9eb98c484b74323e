from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.keyed import dedup_latest, merge_snapshot, upsert


@pytest.mark.parametrize("ties", ["one", "all"])
def test_dedup_latest_keeps_newest(spark, ties):
    readings = [("w7", 2, datetime(2021, 3, day, hour), level) for day, hour, level in [(4, 9, 1.5), (11, 6, 0.25), (4, 23, 8.0)]]
    df = spark.createDataFrame(readings, "well string, probe int, seen timestamp, level double")
    got = dedup_latest(df, ["well", "probe"], "seen", ties=ties)
    assert got.columns == df.columns
    assert [r.level for r in got.collect()] == [0.25]


def test_dedup_latest_exact_tie(spark, rows):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 0, "c")], "k string, o int, v string")
    assert rows(dedup_latest(df, "k", "o"), "v") == [("b",)]
    assert rows(dedup_latest(df.orderBy("v"), "k", "o"), "v") == [("b",)]
    assert rows(dedup_latest(df, "k", "o", ties="all"), "v") == [("a",), ("b",)]


def test_dedup_latest_null_order_and_null_keys(spark, rows):
    df = spark.createDataFrame(
        [("k", None, "a"), ("k", 1, "b"), ("n", None, "c"), (None, 1, "d"), (None, 2, "e")],
        "k string, o int, v string",
    )
    assert rows(dedup_latest(df, "k", "o"), "v") == [("b",), ("c",), ("e",)]
    assert rows(dedup_latest(df, "k", "o", ties="all"), "v") == [("b",), ("e",)]


def test_dedup_latest_empty_and_bad_arguments(spark):
    df = spark.createDataFrame([], "k string, o int")
    assert dedup_latest(df, "k", "o").count() == 0
    assert dedup_latest(df, "k", "o", ties="all").count() == 0
    with pytest.raises(ValueError):
        dedup_latest(df, "k", "o", ties="some")


def test_dedup_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup_latest(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < partial


def test_dedup_latest_all_with_hot_key_equals_plain(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("o"),
        "id",
    )
    salted = dedup_latest(df, "k", "o", ties="all", rows_per_salt=50)
    assert rows(salted) == rows(dedup_latest(df, "k", "o", ties="all"))
    newest = df.groupBy("k").agg(F.max("o").alias("o"))
    assert salted.count() == df.join(newest, ["k", "o"]).count()


def test_merge_snapshot(spark, rows):
    history = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert rows(merge_snapshot(history, updates, "id")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(upsert(history, updates, "id")) == [(1, "a"), (2, None), (3, "c")]


def test_merge_snapshot_columns_follow_history(spark, rows):
    history = spark.createDataFrame([(1, "a", 1.0)], "id int, v string, w double")
    updates = spark.createDataFrame([("x", 1, "b"), ("y", 2, "c")], "extra string, id long, v string")
    merged = merge_snapshot(history, updates, "id")
    assert merged.dtypes == history.dtypes
    assert rows(merged) == [(1, "b", 1.0), (2, "c", None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("value", "kind"), [("abc", "string"), (3_000_000_000, "long"), (1.5, "double"), (float("nan"), "double")]
)
def test_values_that_do_not_fit_raise(spark, ansi, value, kind):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        history = spark.createDataFrame([(1, 5)], "id int, v int")
        for schema, row in ((f"id {kind}, v int", (value, 1)), (f"id int, v {kind}", (1, value))):
            updates = spark.createDataFrame([row], schema)
            for merge in (merge_snapshot, upsert):
                with pytest.raises(Exception, match="does not fit"):
                    merge(history, updates, "id")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_values_that_fit_are_converted(spark, rows):
    history = spark.createDataFrame([(1, 5)], "id int, v int")
    updates = spark.createDataFrame([("1", 7.0), ("2", None)], "id string, v double")
    assert rows(upsert(history, updates, "id")) == [(1, 7), (2, None)]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_merge_snapshot_equals_full_outer_join(spark, rows, broadcast_rows):
    history = spark.range(0, 200, 3).select(
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("a"),
        (F.col("id") % 4).alias("b"),
        F.col("id").alias("v"),
    )
    updates = spark.range(0, 200, 2).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("a"),
        (F.col("id") % 4).alias("b"),
        F.when(F.col("id") % 3 == 0, None).otherwise(-F.col("id")).alias("v"),
    )
    plain = (
        history.alias("h")
        .join(updates.alias("u"), ["a", "b"], "fullouter")
        .select("a", "b", F.coalesce("u.v", "h.v"))
    )
    merged = merge_snapshot(history, updates, ["a", "b"], broadcast_rows=broadcast_rows)
    assert rows(merged) == rows(plain)


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_merge_broadcasts_counted_updates_only(spark, tmp_path, broadcast_rows):
    spark.range(100_000).select("id", F.col("id").alias("v")).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    updates = spark.range(3).select("id", F.lit(1).cast("long").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_snapshot(history, updates, "id", broadcast_rows=broadcast_rows)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 100_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if broadcast_rows:
        # Only the few matched keys are shuffled, to make them distinct.
        assert "SortMergeJoin" not in plan
        assert plan.count("Exchange hashpartitioning") == 1
    else:
        assert plan.count("SortMergeJoin") == 2
        assert "BroadcastExchange" not in plan


def test_merge_sees_one_version_of_a_random_source(spark):
    history = spark.range(200).select("id", F.lit(0.0).alias("v"))
    updates = spark.range(400).where(F.rand() < 0.5).select("id", F.rand().alias("v"))
    merged = merge_snapshot(history, updates, "id")
    assert merged.count() == merged.select("id").distinct().count() >= 200


def test_upsert_column_lists(spark, rows):
    target = spark.createDataFrame(
        [(1, "foo_1", "d1", "2022-04-26"), (3, "foo_3", "d3", "2022-04-26")],
        "id long, label string, description string, date string",
    )
    source = spark.createDataFrame(
        [(1, "new_1", "s1", "2022-04-24"), (9, "new_9", "s9", "2022-04-24")],
        "id long, label string, description string, date string",
    )
    got = upsert(
        target,
        source,
        "id",
        update_cols=["label", "description", "date"],
        insert_cols=["id", "label"],
    )
    assert rows(got) == [
        (1, "new_1", "s1", "2022-04-24"),
        (3, "foo_3", "d3", "2022-04-26"),
        (9, "new_9", None, None),
    ]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(2, "a"), (2, "b")], "id int, v string")
    with pytest.raises(ValueError, match="duplicate"):
        upsert(target, source, "id")
    with pytest.raises(ValueError, match="missing"):
        upsert(target, target, "id", update_cols=["nope"])


def test_upsert_null_keys_never_match(spark, rows):
    target = spark.createDataFrame([(None, "t"), (1, "a")], "id int, v string")
    source = spark.createDataFrame([(None, "s"), (None, "s2"), (1, "b")], "id int, v string")
    assert rows(upsert(target, source, "id")) == [
        (1, "b"),
        (None, "s"),
        (None, "s2"),
        (None, "t"),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "kind, text, fits",
    [
        ("int", "7", True), ("int", "007", False), ("int", " 7", False), ("int", "7.0", False),
        ("date", "2024-05-05", True), ("date", "2024-05-05 10:30:00", False), ("date", " 2024 ", False),
        ("timestamp", "2024-05-05 10:30:00", True), ("timestamp", "2024-05-05", False),
        ("double", "1.50", True), ("double", "1,5", False), ("decimal(6,2)", "1.5", True),
        ("decimal(6,2)", "1.505", False), ("boolean", "true", True), ("boolean", "yes", False),
    ],
)
def test_text_is_merged_only_as_it_was_written(spark, ansi, kind, text, fits):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        target = spark.createDataFrame([(1, None)], "id int, v string").selectExpr("id", f"cast(v as {kind}) as v")
        source = spark.createDataFrame([(1, text)], "id int, v string")
        if fits:
            got = upsert(target, source, "id").first()["v"]
            assert got == spark.createDataFrame([(text,)], "v string").selectExpr(f"cast(v as {kind}) as v").first()["v"]
        else:
            with pytest.raises(Exception, match="does not fit"):
                upsert(target, source, "id").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
