"""Windowed aggregates over a stream of files, with a watermark for late rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.joins import as_list
from tarnwork.operators.ranges import as_number


def read_file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    pattern: str | None = None,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The files of a folder as a stream; ``pattern`` chooses among their names.

    ``files_per_batch`` bounds a micro-batch, also with :func:`run_available`.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _instant(df: DataFrame, time: str) -> Column:
    """A time column as a point in time; one without a zone is read as UTC."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(time)
    return F.timestamp_micros(as_number(time, kind))


def _like(instant: Column, kind: T.DataType) -> Column:
    """A point in time in the type of the column it came from."""
    if isinstance(kind, T.TimestampType):
        return instant
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(18,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(zero, zero, zero, seconds)


def windowed(
    stream: DataFrame,
    time: str,
    width: str,
    delay: str,
    aggregates: Mapping[str, Column],
    keys: str | Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """``keys, window_start, window_end`` and ``aggregates`` of tumbling or sliding windows.

    A window is complete, and in append mode written, once a time of ``delay`` beyond its
    end was seen; rows that come for it after that are dropped. State is kept for open
    windows only. Rows without a time belong to no window. Works on a batch as well,
    where all windows are complete and no row is late. Windows begin at multiples of
    ``slide`` (default: ``width``) in UTC.
    """
    kind = stream.schema[time].dataType
    timed = stream.where(F.col(time).isNotNull()).withColumn("_at", _instant(stream, time))
    marked = timed.withWatermark("_at", delay)
    window = F.window("_at", width, slide) if slide else F.window("_at", width)
    found = marked.groupBy(window.alias("_w"), *as_list(keys)).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    return found.select(
        *as_list(keys), _like(F.col("_w.start"), kind).alias("window_start"),
        _like(F.col("_w.end"), kind).alias("window_end"), *aggregates,
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, **options: str) -> None:
    """Process what is there and stop; parquet at ``path``, each result written once.

    ``checkpoint`` is a folder that outlives the job: a later run goes on from it, with the
    windows that are still open, and one that broke off repeats its last batch. Both
    folders have to be shared by all executors.
    """
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).options(**options)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
