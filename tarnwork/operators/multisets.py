"""Set operations that count copies: intersect all, except all, symmetric difference.

Equal rows are counted before the shuffle, however many there are, and written out again
at the end, the copies of one row by several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.joins import comparable_columns
from tarnwork.scratch import materialize

#: Copies of one row that are written by one task.
COPIES_PER_TASK = 100_000
#: Rows with more copies than that are dealt to so many tasks at most, or to as many as a
#: shuffle of the session has, if that is more.
MAX_TASKS = 200


def _combine(left: DataFrame, right: DataFrame, copies: Column, copies_per_task: int) -> DataFrame:
    if left.columns != right.columns:
        raise ValueError("both sides need the same columns in the same order")
    if len(comparable_columns(left)) < len(left.columns):
        raise ValueError("columns that hold maps cannot be compared")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.select("*", one.alias("_l"), none.alias("_r")).union(
        right.select("*", none.alias("_l"), one.alias("_r"))
    )
    counted = both.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    kept = counted.select(*left.columns, copies.alias("_n")).where("_n > 0")
    kept = materialize(kept, "multiset")
    chunks = F.ceil(F.col("_n") / copies_per_task).cast("long")
    big = F.col("_n") > copies_per_task
    n_chunks = kept.where(big).agg(F.sum(chunks)).first()[0]
    rows = kept.where(~big).withColumn("_here", F.col("_n"))
    if n_chunks:
        spread = kept.where(big).withColumn("_part", F.explode(F.sequence(one, chunks)))
        # A number is given, or the few short rows would be put together again.
        tasks = min(n_chunks, max(MAX_TASKS, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        spread = spread.repartition(tasks, F.xxhash64(*left.columns, "_part"))
        before = (F.col("_part") - 1) * copies_per_task
        here = F.least(F.col("_n") - before, F.lit(copies_per_task).cast("long"))
        rows = rows.unionByName(spread.withColumn("_here", here).drop("_part"))
    return rows.withColumn("_copy", F.explode(F.sequence(one, F.col("_here")))).select(*left.columns)


def intersect_all(
    left: DataFrame, right: DataFrame, copies_per_task: int = COPIES_PER_TASK
) -> DataFrame:
    """Each row as often as it stands on the side that has fewer of it. NULL equals NULL."""
    return _combine(left, right, F.least("_l", "_r"), copies_per_task)


def except_all(
    left: DataFrame, right: DataFrame, copies_per_task: int = COPIES_PER_TASK
) -> DataFrame:
    """Left rows, one copy less for each equal right row. NULL equals NULL."""
    return _combine(left, right, F.col("_l") - F.col("_r"), copies_per_task)


def symmetric_difference(
    left: DataFrame, right: DataFrame, copies_per_task: int = COPIES_PER_TASK
) -> DataFrame:
    """Rows that one side has more of, as often as it has more. NULL equals NULL."""
    return _combine(left, right, F.abs(F.col("_l") - F.col("_r")), copies_per_task)
