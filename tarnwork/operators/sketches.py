"""Sketches stored per period: distinct counts and quantiles of any range without a rescan.

Each (period, group) is one row of mergeable states: a count, exact sums, a HyperLogLog
sketch per distinct count and a KLL sketch per quantile measure. Rows of a period are
combined before the shuffle, so a hot group sends one sketch per input partition. A range
of periods is answered from those rows alone.

A HyperLogLog sketch takes about 2 ** LG_K bytes, a KLL sketch a few thousand numbers at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.joins import as_list
from tarnwork.sources.files import write_partitioned

#: HyperLogLog keeps 2 ** LG_K registers.
LG_K = 12
#: Numbers kept on the top level of a KLL sketch.
KLL_K = 800


def distinct_error(lg_k: int = LG_K) -> float:
    """Standard error of a merged distinct count, as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """How far, as a share of the rows, a quantile's rank is off at most, 99 times of 100."""
    return 2.296 / k**0.9021


def sketch_rows(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    quantile: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    lg_k: int = LG_K,
    k: int = KLL_K,
) -> DataFrame:
    """One row of states for each value of ``by``.

    ``distinct``, ``quantile`` and ``sums`` are ``{"name": "column"}``. NULL counts in
    ``n_rows`` only; NaN is left out of quantiles too. A measure without any value has an empty sketch, or a NULL sum.
    """
    states = [F.count(F.lit(1)).alias("n_rows")]
    for name, column in (distinct or {}).items():
        states.append(F.hll_sketch_agg(column, lg_k).alias(f"distinct_{name}"))
    for name, column in (quantile or {}).items():
        value = F.col(column).cast("double")
        states.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), k).alias(f"quantile_{name}"))
    for name, column in (sums or {}).items():
        states.append(F.sum(column).alias(f"sum_{name}"))
    return df.groupBy(*by).agg(*states)


def store_sketches(df: DataFrame, path: str, period: str, groups: str | Sequence[str] = (), **measures) -> None:
    """Write the sketches of the periods that occur in ``df``; others stay as they are.

    A period is replaced whole, so storing it again, after late rows or a failed run,
    counts nothing twice: hand in all of its rows. ``period`` is the column that later
    ranges are chosen by, and partitions the folder. ``measures`` are those of ``sketch_rows``.
    """
    write_partitioned(sketch_rows(df, [period, *as_list(groups)], **measures), path, [period])


def read_sketches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored rows of all periods; a filter on the period reads only its folders.

    ``schema`` names the period and group columns with their types, as in ``"month string, mode string"``.
    The rest of the columns is found in the files.
    """
    given = spark.createDataFrame([], schema).schema
    found = spark.read.parquet(path).schema
    for field in given:
        if field.name not in found.names:
            raise ValueError(f"{path} has no column {field.name}")
        found[field.name].dataType = field.dataType
    return spark.read.schema(found).parquet(path)


def merge_sketches(stored: DataFrame, by: str | Sequence[str | Column] = ()) -> DataFrame:
    """States of coarser groups, columns or expressions over the stored ones, from their
    stored states. Without ``by``: one row, also over no states."""
    by = [by] if isinstance(by, (str, Column)) else list(by)
    states = []
    for name in stored.columns:
        if name == "n_rows":
            states.append(F.coalesce(F.sum(name), F.lit(0)).alias(name))
        elif name.startswith("distinct_"):
            states.append(F.hll_union_agg(name).alias(name))
        elif name.startswith("quantile_"):
            states.append(F.kll_merge_agg_double(name).alias(name))
        elif name.startswith("sum_"):
            states.append(F.sum(name).alias(name))
    return stored.groupBy(*by).agg(*states)


def estimates(merged: DataFrame, probs: Sequence[float] = (0.5,)) -> DataFrame:
    """States as figures: ``distinct_x`` as a whole number, ``quantile_x`` as an array in the
    order of ``probs``, NULL where the sketch is empty."""
    if not all(0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    changed = {}
    for name in merged.columns:
        if name.startswith("distinct_"):
            changed[name] = F.hll_sketch_estimate(name)
        elif name.startswith("quantile_"):
            filled = F.kll_sketch_get_n_double(name) > 0
            changed[name] = F.when(filled, F.kll_sketch_get_quantile_double(name, ranks))
    return merged.withColumns(changed) if changed else merged
