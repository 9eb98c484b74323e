"""Grouping sets, rollup and cube from one pass over the rows.

The input is grouped once, by all dimensions, into states that can be merged: counts,
sums, minima, maxima, and bitmaps for distinct counts. Coarser groups are merged from
those states, which are stored; the rows are not repeated once per grouping set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.scratch import materialize

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All dimensions, then one less at a time, from the right."""
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the dimensions."""
    sizes = range(len(dimensions), -1, -1)
    return [chosen for n in sizes for chosen in combinations(dimensions, n)]


def grouping_sets(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, str | None]],
    distinct: tuple[str, str] | None = None,
) -> DataFrame:
    """Aggregates for each of ``sets``: all dimensions, NULL where not grouped by.

    ``grouping`` tells the sets apart, as in SQL's ``grouping_id``: the dimensions, in the
    order in which they first occur, are bits, set where not grouped by. ``measures`` are
    ``{"total": ("sum", "price"), "n": ("count", None)}`` with count, sum, min and max.
    ``distinct`` names a new column and the whole-number column whose different values it
    counts, by bitmaps of 32,768 values; NULL does not count. The empty set has one row
    even over no rows.
    """
    dimensions = list(dict.fromkeys(d for s in sets for d in s))
    unknown = [how for how, _ in measures.values() if how not in _MERGE]
    if unknown:
        raise ValueError(f"measures that cannot be merged: {sorted(set(unknown))}")
    states = []
    for name, (how, column) in measures.items():
        value = F.lit(1) if column is None else F.col(column)
        states.append({"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[how](value).alias(f"_m_{name}"))
    grain = [F.col(d) for d in dimensions]
    if distinct:
        name, column = distinct
        grain.append(F.bitmap_bucket_number(F.col(column).cast("long")).alias("_bucket"))
        states.append(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column).cast("long"))).alias("_bits"))
    finest = materialize(df.groupBy(*grain).agg(*states), "finest")

    def merged(chosen: Sequence[str]) -> DataFrame:
        figures = [_MERGE[how](f"_m_{name}").alias(f"_m_{name}") for name, (how, _) in measures.items()]
        rows = finest
        if distinct:  # bitmaps of one bucket are united, then buckets are added up
            known = F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_bits")).otherwise(0)
            rows = (
                finest.groupBy(*chosen, "_bucket").agg(*figures, F.bitmap_or_agg("_bits").alias("_bits"))
                .withColumn("_d", known)
            )
            figures = [*figures, F.sum("_d").alias("_d")]
        found = rows.groupBy(*chosen).agg(*figures)
        grouping = sum(1 << (len(dimensions) - 1 - i) for i, d in enumerate(dimensions) if d not in chosen)
        none = {name: F.lit(0) for name, (how, _) in measures.items() if how == "count"}
        return found.select(
            *[
                F.col(d) if d in chosen else F.lit(None).cast(df.schema[d].dataType).alias(d)
                for d in dimensions
            ],
            F.lit(grouping).alias("grouping"),
            *[F.coalesce(f"_m_{n}", none[n]).alias(n) if n in none else F.col(f"_m_{n}").alias(n) for n in measures],
            *([F.coalesce("_d", F.lit(0)).alias(distinct[0])] if distinct else []),
        )

    out = merged(sets[0])
    for chosen in sets[1:]:
        out = out.unionByName(merged(chosen))
    return out
