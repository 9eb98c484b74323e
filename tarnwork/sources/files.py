"""File sources and sinks: CSV, JSON, partitioned parquet, tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.scratch import materialize

def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header. Without a schema every column is text; nothing is inferred."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(
    df: DataFrame,
    path: str,
    n_files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """CSV with a header.

    Rows are dealt to ``n_files`` files, each written by one task; None keeps the
    partitions as they are. One file is for reports of known size.
    """
    if n_files is not None:
        df = df.repartition(n_files)
    df.write.mode(mode).option("header", True).csv(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """JSON files. ``multiline`` documents cannot be split; use False for JSON lines."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_table(
    spark: SparkSession,
    fmt: str,
    source: str,
    columns: Sequence[str] | None = None,
    predicate: str | Column | None = None,
    **options: str,
) -> DataFrame:
    """Any connector, with the filter and the projection where Spark can push them down."""
    df = spark.read.format(fmt).options(**options).load(source)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet, optionally in partition directories.

    With ``by``, overwriting replaces only the partitions that occur in ``df``.
    Rows are first brought together by partition, so a directory gets few files;
    the rebalance step splits a partition value that holds too many rows for one
    task.
    """
    if not by:
        df.write.mode(mode).parquet(path)
        return
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def read_partitions(
    spark: SparkSession,
    path: str,
    day: str | None = None,
    months: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A dataset partitioned by year, month and day, cut to one day or some months.

    ``day`` is ``yyyyMMdd``, a month ``yyyyMM``. The conditions are on partition
    columns, so only the matching directories are read; a day without rows gives
    an empty result.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if day is not None:
        date = datetime.strptime(day, "%Y%m%d")
        df = df.where(
            (F.col("year") == date.year)
            & (F.col("month") == date.year * 100 + date.month)
            & (F.col("day") == int(day))
        )
    if months is not None:
        parsed = [datetime.strptime(m, "%Y%m") for m in months]
        df = df.where(
            F.col("year").isin(sorted({m.year for m in parsed}))
            & F.col("month").isin([m.year * 100 + m.month for m in parsed])
        )
    return df


def list_periods(df: DataFrame, date_col: str, fmt: str = "yyyyMM") -> DataFrame:
    """The distinct periods of a date column as text, in order."""
    period = F.date_format(F.col(date_col), fmt).alias("period")
    return df.select(period).distinct().orderBy("period")


def publish(df: DataFrame, *sinks) -> DataFrame:
    """Compute ``df`` once, hand the stored result to every sink, and return it."""
    stored = materialize(df, "publish")
    for sink in sinks:
        sink(stored)
    return stored
