"""Population stability: binning, shares, PSI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.functions.columns import bin_index
from tarnwork.operators.joins import as_list, join_groups


def bucketize(
    df: DataFrame, col: str, splits: Sequence[float], open_ended: bool = False, out: str = "bin"
) -> DataFrame:
    """Add the index of the fixed interval that holds ``col``, see :func:`bin_index`."""
    return df.withColumn(out, bin_index(F.col(col), splits, open_ended))


def with_share(
    df: DataFrame, amount: str, by: str | Sequence[str], out: str = "share"
) -> DataFrame:
    """Add each row's part of its group's total; NULL when the total is 0."""
    keys = as_list(by)
    totals = df.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    return (
        join_groups(df, totals, keys)
        .withColumn(out, F.try_divide(F.col(amount).cast("double"), F.col("_total")))
        .drop("_total")
    )


def psi_term(baseline: Column, current: Column, epsilon: float | None = None) -> Column:
    """``(current - baseline) * ln(current / baseline)``, 0 when either share is 0.

    ``epsilon`` lifts shares of 0 to a small floor instead, so one-sided bins
    count.
    """
    if epsilon is not None:
        baseline = F.greatest(baseline, F.lit(epsilon))
        current = F.greatest(current, F.lit(epsilon))
    ratio = F.try_divide(current, baseline)
    return F.coalesce((current - baseline) * F.ln(ratio), F.lit(0.0))


def psi_components(
    df: DataFrame,
    value: str,
    period: str,
    splits: Sequence[float],
    baseline: str,
    current: str,
    open_ended: bool = False,
    epsilon: float | None = None,
) -> DataFrame:
    """One row per bin that occurs in either period: both shares and the PSI term.

    Values without a bin (see :func:`bin_index`) are not counted. One shuffle of
    at most one partial row per bin and map task; everything after that works on
    one row per bin.
    """
    binned = df.select(
        bin_index(F.col(value), splits, open_ended).alias("bin"), F.col(period).alias("_period")
    )
    in_baseline, in_current = F.col("_period") == baseline, F.col("_period") == current
    counts = (
        binned.where(F.col("bin").isNotNull() & (in_baseline | in_current))
        .groupBy("bin")
        .agg(
            F.count_if(in_baseline).alias("_baseline"),
            F.count_if(in_current).alias("_current"),
        )
    )
    # The splits bound this to one row per bin.
    everything = Window.partitionBy(F.lit(1))
    share_of = {
        name: F.coalesce(
            F.try_divide(F.col(f"_{name}"), F.sum(f"_{name}").over(everything)), F.lit(0.0)
        )
        for name in ("baseline", "current")
    }
    shares = counts.select(
        "bin",
        share_of["baseline"].alias("baseline_share"),
        share_of["current"].alias("current_share"),
    )
    return shares.withColumn(
        "psi_component", psi_term(F.col("baseline_share"), F.col("current_share"), epsilon)
    )


def psi(
    df: DataFrame,
    value: str,
    period: str,
    splits: Sequence[float],
    baseline: str,
    current: str,
    open_ended: bool = False,
    epsilon: float | None = None,
) -> DataFrame:
    """The population stability index of two periods as a one-row DataFrame."""
    components = psi_components(
        df, value, period, splits, baseline, current, open_ended, epsilon
    )
    return components.agg(F.coalesce(F.sum("psi_component"), F.lit(0.0)).alias("psi"))
