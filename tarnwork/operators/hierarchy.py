"""Hierarchies given as (child, parent) edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.joins import ROWS_PER_SALT, hot_keys, salted_join
from tarnwork.scratch import materialize


def ancestors(
    edges: DataFrame,
    child: str,
    parent: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Every (node, ancestor) pair with the shortest distance as ``depth``.

    A node is never its own ancestor, and cycles end by themselves: they bring
    no new pair.

    The reach doubles per round: pairs up to distance ``2k`` are the pairs up to
    ``k`` plus the pairs at exactly ``k`` extended by pairs up to ``k``. A
    hierarchy of depth d takes about log2(d) rounds instead of d, and the pairs
    found in a round are written once, so the plan stays short. Roots are the
    ancestors of most nodes, hence the salted join.
    """
    reached = materialize(
        edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"))
        .where(F.col("ancestor").isNotNull() & (F.col("node") != F.col("ancestor")))
        .distinct()
        .withColumn("depth", F.lit(1)),
        "ancestors-1",
    )
    distance = 1
    while True:
        frontier = reached.where(F.col("depth") == distance).select(
            "node", F.col("ancestor").alias("via")
        )
        # A count over written files: none left ends the walk, few need no salt.
        open_pairs = frontier.count()
        if open_pairs == 0:
            return reached
        onward = reached.select(
            F.col("node").alias("via"), "ancestor", (F.col("depth") + distance).alias("depth")
        )
        if open_pairs > rows_per_salt:
            hot = hot_keys(frontier, "via", rows_per_salt=rows_per_salt)
            further = salted_join(frontier, onward, "via", "inner", hot=hot)
        else:
            further = frontier.join(onward, "via")
        nearest = (
            further.where(F.col("node") != F.col("ancestor"))
            .groupBy("node", "ancestor")
            .agg(F.min("depth").alias("depth"))
        )
        known = reached.select("node", "ancestor")
        new = nearest.join(known, ["node", "ancestor"], "left_anti")
        reached = reached.unionByName(materialize(new, f"ancestors-{2 * distance}"))
        distance *= 2


def ancestors_by_role(
    pairs: DataFrame,
    roles: DataFrame,
    node: str,
    role: str,
    role_values: Sequence[str],
    sep: str = ";",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """For every node of ``roles``, its ancestors listed per role, nearest first.

    ``pairs`` is stored, as :func:`ancestors` returns it, so it is counted before
    a salt is considered. One column per value in
    ``role_values``, ``''`` where no ancestor has that role. Ancestors without a
    role join no list. A list never holds more entries than the node has
    ancestors.
    """
    ranked = roles.select(F.col(node).alias("ancestor"), F.col(role).alias("_role")).where(
        F.col("_role").isin(list(role_values))
    )
    if pairs.count() > rows_per_salt:
        hot = hot_keys(pairs, "ancestor", rows_per_salt=rows_per_salt)
        with_role = salted_join(pairs, ranked, "ancestor", "inner", hot=hot)
    else:
        with_role = pairs.join(ranked, "ancestor")
    entry = F.struct("depth", "ancestor")
    lists = with_role.groupBy("node").agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("_role") == value, entry))).alias(f"_list_{i}")
            for i, value in enumerate(role_values)
        ]
    )
    joined = roles.select(F.col(node).alias("node")).distinct().join(lists, "node", "left")
    return joined.select(
        F.col("node").alias(node),
        *[
            F.coalesce(
                F.concat_ws(sep, F.col(f"_list_{i}.ancestor").cast("array<string>")), F.lit("")
            ).alias(value)
            for i, value in enumerate(role_values)
        ],
    )
