"""Versioned tables: each version is a complete parquet snapshot.

``<path>/version=N`` holds version N. A version counts once Spark's ``_SUCCESS``
marker is there, so a write that broke off is never read, and the next version takes a
number above it. One writer at a time: two that start together may pick the same
number, and then usually, but not always, one of them fails. Nothing is overwritten.

:func:`upsert_partitions` changes a plain partitioned table in place instead.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.joins import as_list, fits_broadcast
from tarnwork.operators.keyed import upsert
from tarnwork.scratch import materialize
from tarnwork.sources.files import write_partitioned


def versions(spark: SparkSession, path: str, unfinished: bool = False) -> list[int]:
    """The complete versions of a table, oldest first; ``unfinished`` ones too if asked."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        match = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if match and (unfinished or fs.exists(marker)):
            found.append(int(match.group(1)))
    return sorted(found)


def _write_version(
    df: DataFrame,
    path: str,
    version: int,
    partition_by: Sequence[str] | None,
    batch: int | None = None,
) -> None:
    # Partition directories carry no types, so the schema is kept next to the data.
    facts = {"schema": df.schema.jsonValue(), "partition_by": list(partition_by or []), "batch": batch}
    schema = df.sparkSession.range(1).select(F.lit(json.dumps(facts)).alias("facts"))
    schema.coalesce(1).write.mode("overwrite").text(f"{path}/_schema/version={version}")
    target = f"{path}/version={version}"
    if not partition_by:
        df.write.mode("errorifexists").parquet(target)
        return
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by])
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(target)


def create_versioned(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None
) -> DataFrame:
    """Write the first version and return it."""
    if versions(df.sparkSession, path):
        raise ValueError(f"a versioned table already exists at {path}")
    version = max(versions(df.sparkSession, path, unfinished=True), default=-1) + 1
    _write_version(df, path, version, partition_by)
    return read_version(df.sparkSession, path, version)


def add_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    batch: int | None = None,
) -> int:
    """Write ``df`` as the next version, the first one too; its number.

    ``batch`` is kept with the version, see :func:`latest_batch`: both count or neither.
    """
    version = max(versions(df.sparkSession, path, unfinished=True), default=-1) + 1
    _write_version(df, path, version, partition_by, batch)
    return version


def latest_batch(spark: SparkSession, path: str) -> int | None:
    """The batch number of the latest version, if there is one and it has one."""
    known = versions(spark, path)
    return _facts(spark, path, known[-1]).get("batch") if known else None


def _facts(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{path}/_schema/version={version}").first()[0])


def read_version(
    spark: SparkSession,
    path: str,
    version: int | None = None,
) -> DataFrame:
    """One version of a table, by default the latest."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"no versioned table at {path}")
    if version is None:
        version = known[-1]
    elif version not in known:
        raise ValueError(f"version {version} not found at {path}; there are {known}")
    schema = T.StructType.fromJson(_facts(spark, path, version)["schema"])
    return spark.read.schema(schema).parquet(f"{path}/version={version}").select(*schema.names)


def upsert_versioned(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: str | Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
) -> int:
    """Merge ``source`` into the latest version, write the result as the next one.

    Returns the new version number. Earlier versions stay readable. Unless
    ``partition_by`` is given, the layout of the latest version is kept.
    """
    target = read_version(spark, path)
    latest = versions(spark, path)[-1]
    if partition_by is None:
        partition_by = _facts(spark, path, latest)["partition_by"]
    merged = upsert(target, source, keys, update_cols, insert_cols)
    version = versions(spark, path, unfinished=True)[-1] + 1
    _write_version(merged, path, version, partition_by)
    return version


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: str | Sequence[str],
    partition_by: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
) -> None:
    """Merge ``source`` into a plain parquet table, rewriting only the partitions it touches.

    The partition columns have to be among the keys, so a row never changes its
    partition. Partitions without source rows are neither read nor written. The partition
    columns have the source's types, which the folders' names have to fit.
    """
    key_columns = as_list(keys)
    if not set(partition_by) <= set(key_columns):
        raise ValueError("the partition columns have to be keys")
    stored = materialize(source, "upsert-source")
    touched = materialize(stored.select(*partition_by).distinct(), "touched")
    match = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in partition_by]
    wanted = touched.select(*[F.col(c).alias(f"_t_{c}") for c in partition_by])
    wanted = F.broadcast(wanted) if fits_broadcast(touched) else wanted
    target = _read_typed(spark, path, {c: stored.schema[c].dataType for c in partition_by})
    named = _read_typed(spark, path, {c: T.StringType() for c in partition_by})
    # A folder whose name is not how its value is written would stay beside the new one.
    odd = named.select(*partition_by).distinct().where(
        reduce(
            lambda a, b: a | b,
            [
                ~F.col(c).try_cast(stored.schema[c].dataType).cast("string").eqNullSafe(F.col(c))
                for c in partition_by
            ],
        )
    )
    found = odd.first()
    if found:
        raise ValueError(f"folders of {path} do not fit the source's partition types: {found.asDict()}")
    merged = upsert(target.join(wanted, match, "left_semi"), stored, key_columns, update_cols, insert_cols)
    # Stored first: the write replaces the files that the merge reads.
    write_partitioned(materialize(merged, "upserted"), path, partition_by)


def _read_typed(spark: SparkSession, path: str, types: Mapping[str, T.DataType]) -> DataFrame:
    """A partitioned table with the given types for its partition columns.

    Left to itself Spark guesses them from the folders' names: ``01`` would become 1.
    """
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)
