"""Exact order statistics by histograms that are refined where the answer lies.

Nothing is sorted: a round counts the rows of each key in buckets between the smallest
and the largest value that are still in question, and only the bucket that holds the
wanted rank is looked at again, until its values are all equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.joins import (
    ROWS_PER_SALT,
    as_list,
    fits_broadcast,
    hot_keys,
    salted_join,
)
from tarnwork.scratch import materialize

BUCKETS = 1024


def _bucket(value: Column, low: Column, high: Column, kind: T.DataType) -> Column:
    """A bucket number that never falls as the value rises.

    The two ends have buckets of their own, so each round narrows the range, whatever the
    values between them are; infinite ones too.
    """
    if isinstance(kind, T.IntegralType):  # differences of large numbers must not overflow
        parts = [c.cast("decimal(20,0)") for c in (value, low, high)]
        share = (parts[0] - parts[1]).cast("double") / (parts[2] - parts[1]).cast("double")
    else:
        parts = [c.cast("double") / 2 for c in (value, low, high)]
        share = (parts[0] - parts[1]) / (parts[2] - parts[1])
    inner = F.floor(F.nanvl(share, F.lit(0.0)) * BUCKETS)
    inside = F.greatest(F.lit(1), F.least(inner, F.lit(BUCKETS - 2))).cast("int")
    return F.when(value == low, 0).when(value == high, BUCKETS - 1).otherwise(inside)


def quantiles(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    probs: Sequence[float],
    kind: str = "discrete",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``keys, prob, quantile``, exact, for each key and each of ``probs`` (0 to 1).

    ``discrete``: the smallest value that at least that share of the key's rows does not
    exceed, in the column's type. ``continuous``: linear between the two nearest ranks, a
    double. NULL and NaN are left out; keys without any other value have no rows. NULL is a
    key like any other; without keys all rows are one group.

    Only the scalar "is any range left open" reaches the driver, once a round; a round
    divides the range by about a thousand.
    """
    if kind not in ("discrete", "continuous"):
        raise ValueError("kind is 'discrete' or 'continuous'")
    if not probs or any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    key_columns = as_list(keys)
    data_type = df.schema[value].dataType
    if not isinstance(data_type, T.NumericType):
        raise ValueError(f"{value!r} is not a number")
    names = [f"_k{i}" for i in range(len(key_columns))] or ["_k0"]
    chosen = [F.col(k).alias(n) for k, n in zip(key_columns, names)] or [F.lit(0).alias("_k0")]
    known = F.col(value).isNotNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(value)
    rows = materialize(df.where(known).select(*chosen, F.col(value).alias("_v")), "quantile-rows")
    sizes = materialize(
        rows.groupBy(*names).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        ),
        "quantile-sizes",
    )
    hot = sizes.where(F.col("_n") > rows_per_salt).select(
        *names, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")
    )
    hot = materialize(hot, "quantile-hot")
    prob = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("_p")
    wanted = sizes.select("*", prob)
    place = F.col("_p") * (F.col("_n") - 1)
    if kind == "discrete":
        wanted_ranks = F.array(F.greatest(F.lit(1), F.ceil(F.col("_p") * F.col("_n"))).cast("long"))
    else:
        wanted_ranks = F.array((F.floor(place) + 1).cast("long"), (F.ceil(place) + 1).cast("long"))
    targets = wanted.select(*names, "_p", "_n", F.posexplode(wanted_ranks).alias("_side", "_rank"), "_low", "_high")
    targets = materialize(targets.withColumn("_below", F.lit(0).cast("long")), "quantile-targets")
    while True:
        open_ = targets.where("_low < _high").select(*names, "_low", "_high").distinct()
        open_ = materialize(open_, "quantile-open")
        if open_.isEmpty():
            break
        if fits_broadcast(open_):
            same = [F.col(f"r.{n}").eqNullSafe(F.col(f"o.{n}")) for n in names]
            joined = rows.alias("r").join(F.broadcast(open_.alias("o")), same).select(
                *[F.col(f"r.{n}") for n in names], "_v", "_low", "_high"
            )
        else:
            joined = salted_join(rows, open_, names, "inner", hot=hot, null_safe=True)
        inside = joined.where(F.col("_v").between(F.col("_low"), F.col("_high")))
        bucket = _bucket(F.col("_v"), F.col("_low"), F.col("_high"), data_type)
        counts = inside.groupBy(*names, "_low", "_high", bucket.alias("_b")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        # A row per bucket: at most BUCKETS in a window.
        earlier = Window.partitionBy(*names, "_low", "_high").orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1
        )
        counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
        counts = counts.select(
            *[F.col(n).alias(f"c{n}") for n in names], F.col("_low").alias("c_low"),
            F.col("_high").alias("c_high"), "_c", "_lo", "_hi", "_before",
        )
        here = [F.col(n).eqNullSafe(F.col(f"c{n}")) for n in names]
        place = F.col("_rank") - F.col("_below")
        found = targets.join(
            counts,
            [*here, F.col("_low") == F.col("c_low"), F.col("_high") == F.col("c_high"),
             place > F.col("_before"), place <= F.col("_before") + F.col("_c")],
            "left",
        )
        targets = materialize(
            found.select(
                *names, "_p", "_n", "_side", "_rank", F.coalesce("_lo", "_low").alias("_low"),
                F.coalesce("_hi", "_high").alias("_high"),
                (F.col("_below") + F.coalesce("_before", F.lit(0))).alias("_below"),
            ),
            "quantile-targets",
        )
    out_keys = [F.col(n).alias(k) for n, k in zip(names, key_columns)]
    if kind == "discrete":
        return targets.select(*out_keys, F.col("_p").alias("prob"), F.col("_low").alias("quantile"))
    both = targets.groupBy(*names, "_p", "_n").agg(
        F.min_by("_low", "_side").cast("double").alias("a"), F.max_by("_low", "_side").cast("double").alias("b")
    )
    place = F.col("_p") * (F.col("_n") - 1)
    between = F.col("a") + (F.col("b") - F.col("a")) * (place - F.floor(place))
    quantile = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between)
    return both.select(*out_keys, F.col("_p").alias("prob"), quantile.alias("quantile"))
