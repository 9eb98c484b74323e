"""Mix sources to target weights by hash thresholds (operator 9).

Each document has a fixed 64-bit hash. A source's target is met by taking every
document of it ``floor(target / size)`` times and those under a hash threshold once
more. The thresholds are found without sorting: sizes are summed by source and hash
bucket, running sums name the bucket in which the budget ends, and only that bucket is
summed again at the next 16 bits, until it holds one hash value. A larger budget only
raises thresholds, so mixes of growing budgets are nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.scratch import materialize

#: Bits of the hash that one round of histograms looks at.
ROUND_BITS = 16
ROUNDS = 64 // ROUND_BITS


def word_count(text: str) -> Column:
    """Words of a text column as a long; 0 for null."""
    return F.coalesce(
        F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)
    ).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0
) -> DataFrame:
    """``source, source_size, target`` for every source of ``sized`` (source, size).

    Sources by code point, null last, weigh ``weights`` in turn. The budget, ``share``
    of all sizes, is split by weight; no target exceeds ``most`` times its source's
    size, and what is cut off goes to the others by weight. The level at which it all
    adds up follows from running sums over the sources in the order in which they reach
    their limit, so no iteration is needed. One row per source is sorted, not the data.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ladder = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn(
        "weight", F.element_at(ladder, (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    full_at = F.col("limit") / F.col("weight")
    by_level = Window.orderBy(full_at, F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    # The first source that the level does not fill sets the level for all after it.
    levelled = weighed.withColumn("level", F.when(level <= full_at, level))
    return levelled.select(
        "source",
        "source_size",
        F.least(
            F.col("limit"),
            F.col("weight") * F.coalesce(F.max("level").over(everything), F.lit(float("inf"))),
        ).alias("target"),
    )


def _bits(hashed: Column, round_: int) -> Column:
    """The ``round_``-th group of bits of a hash, from the highest, unsigned."""
    shift = 64 - ROUND_BITS * (round_ + 1)
    return F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << ROUND_BITS) - 1))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source, its whole copies and the hash below which one more is taken.

    ``sized`` has source, size and h; ``targets`` is small: one row per source. Returned
    ``prefix_0 ..`` are the bit groups of the boundary hash, ``takes`` whether the
    documents that have exactly this hash are taken too: whichever comes nearer.
    """
    repeats = F.floor(F.col("target") / F.col("source_size")).cast("long")
    state = targets.withColumn(
        "copies", F.when(F.col("source_size") > 0, repeats).otherwise(F.lit(0).cast("long"))
    ).withColumn("left", F.col("target") - F.col("copies") * F.col("source_size"))
    state = materialize(state, "mix-targets")
    for k in range(ROUNDS):
        prefixes = [f"prefix_{i}" for i in range(k)]
        inside = sized.select("source", "size", *[_bits(F.col("h"), i).alias(f"b{i}") for i in range(k + 1)])
        if k:
            at = state.select(F.col("source").alias("s"), *prefixes)
            match = F.col("source").eqNullSafe(F.col("s"))
            for i in range(k):
                match &= F.col(f"b{i}") == F.col(f"prefix_{i}")
            inside = inside.join(at, match, "left_semi")
        sums = inside.groupBy("source", F.col(f"b{k}").alias("bucket")).agg(
            F.sum("size").alias("in_bucket")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("in_bucket").over(running)).select(
            F.col("source").alias("s"), "bucket", "in_bucket", "upto"
        )
        # The boundary is the first bucket with which the budget is reached, or the last.
        reached = (
            state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
            .groupBy("source")
            .agg(
                F.coalesce(
                    F.min(F.when(F.col("upto") >= F.col("left"), F.struct("bucket", "upto", "in_bucket"))),
                    F.max(F.struct("bucket", "upto", "in_bucket")),
                ).alias("edge")
            )
            .select(F.col("source").alias("s"), "edge")
        )
        state = state.join(reached, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "copies",
            (F.col("left") - (F.col("edge.upto") - F.col("edge.in_bucket"))).alias("left"),
            *prefixes,
            F.col("edge.bucket").alias(f"prefix_{k}"),
            F.col("edge.in_bucket").alias("in_edge"),
        )
        state = materialize(state, "mix-edges")
    return state.withColumn("takes", 2 * F.col("left") >= F.col("in_edge")).drop("in_edge", "left")


def mix(
    sized: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0
) -> DataFrame:
    """``sized`` (source, size, h and more) with ``source_size, target, repeats`` added.

    ``repeats`` is how often the mix takes a document: no more than ``most``, rounded
    up. Documents with equal hashes are decided alike, so a source misses its target
    by at most half the size of the documents that share its boundary hash. Sources
    without words have target and repeats 0. An empty input gives an empty mix. Only
    the table of sources, which :func:`source_targets` sorts, is ever joined.
    """
    targets = source_targets(sized, weights, share, most)
    return apply_thresholds(sized, thresholds(sized, targets))


def apply_thresholds(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (source, h and more) with ``source_size, target, repeats`` added.

    Only ``found``, the table of sources, is joined, so texts need not be shuffled.
    Columns of ``rows`` that have a result's name give way to it.
    """
    kept = [c for c in rows.columns if c not in ("source_size", "target", "repeats")]
    names = ["source", "source_size", "target", "copies", "takes", *[f"prefix_{i}" for i in range(ROUNDS)]]
    found = found.select(*[F.col(c).alias(f"_mix_{c}") for c in names])
    joined = rows.join(found, F.col("source").eqNullSafe(F.col("_mix_source")), "left")
    below, same = F.lit(False), F.lit(True)
    for i in range(ROUNDS):
        bits, edge = _bits(F.col("h"), i), F.col(f"_mix_prefix_{i}")
        below = below | (same & (bits < edge))
        same = same & (bits == edge)
    extra = (below | (same & F.col("_mix_takes"))).cast("long")
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        F.when(F.col("_mix_source_size") > 0, F.col("_mix_copies") + F.coalesce(extra, F.lit(0)))
        .otherwise(F.lit(0)).cast("long").alias("repeats"),
    )


def size_documents(docs: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys, source, size, h``, stored, so that the texts are read only once.

    The hash is that of the keys: a document keeps its place whatever else is in the
    mix. Documents that agree in all keys (repeated rows, null ids) share a hash; give
    the text as one more key where ids are not unique.
    """
    return materialize(
        docs.select(
            *[F.col(f"`{k}`") for k in keys if k != "text"],
            F.col("source"),
            word_count("text").alias("size"),
            F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"),
        ),
        "mix-sizes",
    )
