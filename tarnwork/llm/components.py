"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b): equal labels, one component.

    Every round renames each node to the smallest node next to it and drops edges that
    became loops, so the graph shrinks quickly; the renamings are composed at the end.
    Neighbours are only ever reduced to a minimum, which combines before the shuffle, so
    a node with very many edges is no burden. Each round is stored.
    """
    left = materialize(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    labels = None
    while left.limit(1).count():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m"))
        renamed = materialize(
            near.select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "renamed"
        )
        labels = renamed.withColumnRenamed("to", "label") if labels is None else materialize(
            _follow(labels, "label", renamed, "left").select("node", "label"), "labels"
        )
        left = materialize(
            _follow(_follow(left, "a", renamed, "inner"), "b", renamed, "inner")
            .where(F.col("a") != F.col("b"))
            .select("a", "b")
            .distinct(),
            "edges",
        )
    if labels is None:
        kind = left.schema["a"].dataType
        labels = left.select(F.col("a").alias("node"), F.col("a").cast(kind).alias("label"))
    return labels


def _follow(rows: DataFrame, column: str, renamed: DataFrame, how: str) -> DataFrame:
    """``rows`` with ``column`` renamed; what has no new name keeps its own."""
    table = renamed.select(F.col("node").alias("_from"), F.col("to").alias("_to"))
    joined = rows.join(table, F.col(column) == F.col("_from"), how)
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")
