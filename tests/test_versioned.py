from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tarnwork.sources.versioned import (
    create_versioned,
    read_version,
    upsert_partitions,
    upsert_versioned,
    versions,
)


def test_upsert_and_time_travel(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    target = spark.createDataFrame([(10, "oak"), (20, "elm"), (30, "yew")], "id long, tree string")
    source = spark.createDataFrame([(20, "ash"), (40, "fir")], "id long, tree string")
    assert rows(create_versioned(target, path)) == rows(target)
    assert upsert_versioned(spark, path, source, "id", ["tree"], ["id", "tree"]) == 1
    assert rows(read_version(spark, path)) == [(10, "oak"), (20, "ash"), (30, "yew"), (40, "fir")]
    assert rows(read_version(spark, path, 0)) == rows(target)
    assert upsert_versioned(spark, path, source.limit(0), "id") == 2
    assert versions(spark, path) == [0, 1, 2]
    assert rows(read_version(spark, path, 2)) == rows(read_version(spark, path, 1))


def test_partitioned_table_keeps_its_layout(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    target = spark.range(5000).select(
        "id", (F.col("id") * 2).alias("amount"), F.format_string("zone%d", F.col("id") % 4).alias("zone")
    )
    source = spark.createDataFrame([(7, -1, "zone9"), (9000, 5, "zone9")], target.schema)
    create_versioned(target, path, partition_by=["zone"])
    upsert_versioned(spark, path, source, "id")
    latest = read_version(spark, path)
    assert latest.dtypes == target.dtypes
    assert latest.count() == 5001
    assert rows(latest.where("zone = 'zone9'"), "id", "amount") == [(7, -1), (9000, 5)]
    assert latest.where("id = 7").count() == 1
    plan = latest.where("zone = 'zone9'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(zone" in plan
    assert len(glob.glob(f"{path}/version=1/zone=*")) == 5
    assert rows(read_version(spark, path, 0).where("id = 7"), "zone") == [("zone3",)]


def test_a_broken_write_does_not_block_the_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    create_versioned(spark.range(3).toDF("id"), path)
    (tmp_path / "t" / "version=1").mkdir()
    assert upsert_versioned(spark, path, spark.range(3, 5).toDF("id"), "id") == 2
    assert versions(spark, path) == [0, 2]
    assert rows(read_version(spark, path)) == [(i,) for i in range(5)]


def test_upsert_of_touched_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(i, i % 3, "old") for i in range(9)], "id int, part int, note string")
    old.write.partitionBy("part").parquet(path)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/part=*/*.parquet")}
    source = spark.createDataFrame([(1, 1, "new"), (100, 1, "new"), (200, 7, "new")], old.schema)
    upsert_partitions(spark, path, source, ["part", "id"], ["part"])
    got = spark.read.parquet(path).select("id", "part", "note")
    changed = {(1, 1): "new", (100, 1): "new", (200, 7): "new"}
    expected = {(i, i % 3): "old" for i in range(9)} | changed
    assert rows(got) == sorted(((i, p, n) for (i, p), n in expected.items()), key=repr)
    after = set(glob.glob(f"{path}/part=*/*.parquet"))
    untouched = {f for f in before if "part=1" not in f}
    assert untouched <= after and all(os.path.getmtime(f) == before[f] for f in untouched)
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, source, ["id"], ["part"])


def test_unfinished_versions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        read_version(spark, path)
    with pytest.raises(ValueError):
        upsert_versioned(spark, path, spark.range(3).toDF("id"), "id")
    create_versioned(spark.range(3).toDF("id"), path)
    (tmp_path / "t" / "version=1").mkdir()
    assert versions(spark, path) == [0]
    with pytest.raises(ValueError):
        read_version(spark, path, 1)
    with pytest.raises(ValueError):
        create_versioned(spark.range(3).toDF("id"), path)


def test_upsert_partitions_keeps_text_partitions(spark, tmp_path):
    """Months such as 01 stay text; only the touched one is rewritten."""
    path = str(tmp_path / "by-month")
    rows = [("01", "k1", 1), ("02", "k1", 2), ("02", "k2", 3)]
    spark.createDataFrame(rows, "m string, k string, v int").write.partitionBy("m").parquet(path)
    changed = spark.createDataFrame([("01", "k1", 9), ("01", "k9", 8)], "m string, k string, v int")
    upsert_partitions(spark, path, changed, ["m", "k"], ["m"])
    stored = spark.read.schema("k string, v int, m string").parquet(path)
    assert sorted(tuple(r) for r in stored.select("m", "k", "v").collect()) == [
        ("01", "k1", 9), ("01", "k9", 8), ("02", "k1", 2), ("02", "k2", 3),
    ]
    assert sorted(p.name for p in (tmp_path / "by-month").glob("m=*")) == ["m=01", "m=02"]
    as_number = changed.withColumn("m", changed["m"].cast("int"))
    with pytest.raises(ValueError, match="do not fit"):
        upsert_partitions(spark, path, as_number, ["m", "k"], ["m"])
