"""Per-group statistics and the dominant key of a group.

These give what windows over whole groups would give, but a group is never
gathered in one task: sums, maxima and tie counts are aggregates that combine
on the map side, and row numbers come from range-partitioned pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.operators.joins import ROWS_PER_SALT, as_list, comparable_columns, join_groups
from tarnwork.scratch import materialize


def _group_peaks(df: DataFrame, group: list[str], key: str, value: str, incumbent: str | None):
    """Per group: the maximum, how many rows share it, their smallest key, the incumbent.

    Two algebraic steps, per (group, value) and per group.
    """
    known = F.max(incumbent) if incumbent else F.lit(None).cast("string")
    per_value = df.groupBy(*group, value).agg(
        F.count(F.lit(1)).alias("_ties"),
        F.min(key).alias("_first_key"),
        known.alias("_incumbent"),
    )
    best = F.max_by(F.struct("_ties", "_first_key"), value)
    return per_value.groupBy(*group).agg(
        F.max(value).alias("_max"),
        best.alias("_best"),
        F.max("_incumbent").alias("_incumbent"),
    )


def dominant_key(
    df: DataFrame, group: str | Sequence[str], key: str, value: str, incumbent: str
) -> DataFrame:
    """One (key, reason) per group, for rows already summed per key.

    ``unique``: a single row holds the maximum, its key wins. ``incumbent``: the
    maximum is shared and the group has an incumbent, which wins even when it is
    not among the tied keys. ``tie_break``: shared, no incumbent, the smallest
    tied key wins. Groups without any value are left out.
    """
    groups = as_list(group)
    peaks = _group_peaks(df, groups, key, value, incumbent).where(F.col("_max").isNotNull())
    unique = F.col("_best._ties") == 1
    has_incumbent = F.col("_incumbent").isNotNull()
    first_key = F.col("_best._first_key")
    return peaks.select(
        *groups,
        F.when(unique, first_key)
        .when(has_incumbent, F.col("_incumbent"))
        .otherwise(first_key)
        .alias(key),
        F.when(unique, "unique")
        .when(has_incumbent, "incumbent")
        .otherwise("tie_break")
        .alias("reason"),
    )


def _leaders(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The rows that lead their group within their input partition; stored, with ``_part``.

    They hold all rows with the group's maximum, and little else. Spark drops the other
    rows on the map side, before the shuffle. Because the partition is part of the
    window's key, the rows of one group, exact copies too, stay spread over many tasks,
    and a task that runs again sends its rows to the same place.
    """
    inside = Window.partitionBy(*groups, "_part").orderBy(F.col(value).desc())
    ranked = (
        df.where(F.col(value).isNotNull())
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_rank", F.rank().over(inside))
    )
    return materialize(ranked.where(F.col("_rank") == 1).drop("_rank"), "leaders")


def max_rows(
    df: DataFrame,
    group: str | Sequence[str],
    value: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """All rows whose value equals their group's maximum."""
    groups = as_list(group)
    leaders = _leaders(df, groups, value)
    peaks = leaders.groupBy(*groups).agg(F.max(value).alias("_max"))
    return (
        join_groups(leaders, peaks, groups, rows_per_salt=rows_per_salt, part="_part")
        .where(F.col(value) == F.col("_max"))
        .drop("_max", "_part")
    )


def tied_keys(
    df: DataFrame,
    group: str | Sequence[str],
    key: str,
    value: str,
    min_ties: int = 3,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """The keys that share a group's maximum, where at least ``min_ties`` rows do."""
    groups = as_list(group)
    leaders = _leaders(df.select(*groups, key, value), groups, value)
    peaks = (
        _group_peaks(leaders, groups, key, value, None)
        .where(F.col("_best._ties") >= min_ties)
        .select(*groups, "_max")
    )
    return (
        join_groups(leaders, peaks, groups, rows_per_salt=rows_per_salt, part="_part")
        .where(F.col(value) == F.col("_max"))
        .select(*groups, key)
        .distinct()
    )


def group_stats(
    df: DataFrame, group: str | Sequence[str], key: str, value: str, incumbent: str
) -> DataFrame:
    """Add the group's ``max_value``, ``group_incumbent``, each row's ``row_number``
    by (value, key, remaining columns), and ``equal_count``: how many rows share
    the row's value if that is the maximum, else 0.

    Rows are range-partitioned in that order within their group, so a wide group is cut
    into consecutive pieces. Each piece numbers its own rows and adds the size
    of the group's earlier pieces. The range-partitioned rows are written once:
    range bounds come from a sample, and both uses have to see the same ones.
    """
    groups = as_list(group)
    rest = [c for c in comparable_columns(df) if c not in {*groups, value, key}]
    order = [value, key, *rest]
    ranged = materialize(
        df.repartitionByRange(*groups, *order).withColumn("_piece", F.spark_partition_id()),
        "group-stats",
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per group and piece: at most as many rows per group as partitions.
    pieces = (
        ranged.groupBy(*groups, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    peaks = _group_peaks(ranged, groups, key, value, incumbent)
    renamed = peaks.select(
        *[F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)], "_max", "_best", "_incumbent"
    )
    same_group = [F.col(g).eqNullSafe(F.col(f"_g_{i}")) for i, g in enumerate(groups)]
    pieces = pieces.join(renamed, same_group).drop(*groups).withColumnRenamed("_piece", "_p")
    in_piece = Window.partitionBy("_piece", *groups).orderBy(*order)
    numbered = ranged.withColumn("_number", F.row_number().over(in_piece))
    is_max = F.col(value) == F.col("_max")
    return numbered.join(pieces, [F.col("_piece") == F.col("_p"), *same_group]).select(
        *df.columns,
        F.col("_max").alias("max_value"),
        F.col("_incumbent").alias("group_incumbent"),
        (F.col("_number") + F.col("_offset")).alias("row_number"),
        F.when(is_max, F.col("_best._ties")).otherwise(F.lit(0)).alias("equal_count"),
    )
