"""Shards of nearly equal bytes by Karmarkar-Karp differencing (operator 5).

Differencing repeatedly takes the two partial partitions with the largest spread and
adds them in opposite order, largest part to smallest, until one is left. Here it runs
in levels. Indivisible groups are dealt by hash into cells of bounded size; each cell
is differenced by one task into one partial partition. These are then differenced in
turn, many to a task, until one is left. Its parts are the shards, and each level's
choices are followed back down. No task sees more than a cell, and the partial
partitions of cells have small spreads unless a group is huge, which the next levels
then balance.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.scratch import materialize

#: Groups or partial partitions that one task differences.
CELL = 8192


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (one per row) into one.

    Returns its sums, and for each input the output part that takes each of its parts.
    Ties are broken by position, so the result depends on the order of rows alone.
    """
    n, k = parts.shape
    sums = [tuple(row) for row in parts.tolist()]
    # Part j of a node is, in sorted order, the one that was added j-th.
    heap, made = [], []
    for node, row in enumerate(sums):
        order = sorted(range(k), key=lambda j: (row[j], j))
        heap.append((row[order[0]] - row[order[-1]], node, [row[j] for j in order]))
        made.append((None, None, order))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, low_a = heapq.heappop(heap)
        _, b, low_b = heap[0]
        # Smallest of one with largest of the other.
        joint = [x + y for x, y in zip(low_a, reversed(low_b))]
        order = sorted(range(k), key=joint.__getitem__)
        joint = [joint[j] for j in order]
        heapq.heapreplace(heap, (joint[0] - joint[-1], len(made), joint))
        made.append((a, b, order))
    goes: list[list[int] | None] = [None] * len(made)
    goes[-1] = list(range(k))
    taken = np.empty((n, k), np.int64)
    for node in range(len(made) - 1, -1, -1):
        a, b, order = made[node]
        places = [0] * k
        for rank, j in enumerate(order):
            places[j] = goes[node][rank]
        goes[node] = None
        if a is None:
            taken[node] = places
        else:
            goes[a] = places
            goes[b] = places[::-1]
    return np.array(heap[0][2], np.int64), taken


def _difference_cell(table: pd.DataFrame, n_shards: int) -> pd.DataFrame:
    table = table.sort_values(["item"], kind="stable")
    sums, taken = difference(np.array(table["parts"].tolist(), np.int64).reshape(-1, n_shards))
    return pd.DataFrame(
        {
            "up": table["up"].iloc[0],
            "item": table["item"].to_numpy(),
            "goes": taken.tolist(),
            "sums": [sums.tolist()] + [None] * (len(table) - 1),
        }
    )


def place_groups(groups: DataFrame, n_shards: int, cell: int = CELL) -> DataFrame:
    """``item, shard`` for every row of ``groups`` (item, bytes); items are unique.

    Byte sums of the shards differ by about the smallest spread differencing finds; a
    group larger than an even share stays whole and makes its shard the largest.
    """
    n = groups.count()
    if n_shards == 1 or not n:
        return groups.select("item", F.lit(0).alias("shard"))
    none = [F.lit(0).cast("long")] * (n_shards - 1)
    level = groups.select(
        F.col("item").cast("string").alias("item"),
        F.array(F.col("bytes").cast("long"), *none).alias("parts"),
    )
    work = partial(_difference_cell, n_shards=n_shards)
    schema = "up string, item string, goes array<bigint>, sums array<bigint>"
    levels, done = [], False
    while not done:
        cells = -(-n // cell)
        done, n = cells == 1, cells
        hashed = F.pmod(F.xxhash64(F.lit(len(levels)), "item"), F.lit(cells)).cast("string")
        dealt = level.withColumn("up", hashed)
        found = materialize(dealt.groupBy("up").applyInPandas(work, schema), "shard-level")
        levels.append(found.select("up", "item", "goes"))
        level = found.where(F.col("sums").isNotNull()).select(
            F.col("up").alias("item"), F.col("sums").alias("parts")
        )
    # Down again: where each part of a cell has ended up.
    ends = levels.pop()
    while levels:
        upper = ends.select(F.col("item").alias("up"), F.col("goes").alias("then"))
        ends = levels.pop().join(upper, "up").select(
            "up", "item", F.transform("goes", lambda j: F.get("then", j.cast("int"))).alias("goes")
        )
    # A group is the first part of its own partial partition; the rest are empty.
    return ends.select("item", F.get("goes", F.lit(0)).cast("int").alias("shard"))


def with_slots(placed: DataFrame, spread_by: Column, rows_per_piece: int = 100_000) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... within each shard, without sorting a shard as a whole.

    Rows are cut by the hash ``spread_by`` into pieces of about ``rows_per_piece``;
    pieces are counted, and a row's slot is its number in its piece plus the rows of the
    pieces before it. Rows with equal hashes share a piece.
    """
    stored = materialize(placed.withColumn("_h", spread_by), "shard-rows")
    n_pieces = -(-max(1, stored.count()) // rows_per_piece)
    pieced = stored.withColumn("_piece", F.pmod("_h", F.lit(n_pieces)))
    counts = pieced.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        "shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("shard", "_piece").orderBy("_h", *placed.columns)
    numbered = pieced.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "_piece"]).select(
        *placed.columns, (F.col("_start") + F.col("_row")).cast("long").alias("slot")
    )


def shard_by_bytes(
    docs: DataFrame, keep: tuple[str, ...], n_shards: int = 8, text: str = "text", cell: int = CELL
) -> DataFrame:
    """``keep`` columns with ``size, text_crc32, shard, slot`` of every document.

    Kept columns of those four names give way to the results.

    Size is the UTF-8 length plus 1 (null: 1). Documents of equal texts (by 128-bit
    digest; null counts as a text of its own) form a group that no shard boundary cuts,
    however often a row is repeated. Group sizes are summed before the shuffle. An empty
    table gives no rows.
    """
    keep = tuple(c for c in keep if c not in ("size", "text_crc32", "shard", "slot"))
    body = F.col(f"`{text}`")
    rows = materialize(
        docs.select(
            *[F.col(f"`{c}`") for c in keep],
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.md5(body.cast("binary")), F.lit("null")).alias("_item_"),
        ),
        "shard-texts",
    )
    groups = rows.groupBy(F.col("_item_").alias("item")).agg(F.sum("size").alias("bytes"))
    shards = place_groups(groups, n_shards, cell).withColumnRenamed("item", "_item_")
    placed = rows.join(shards, "_item_").drop("_item_")
    return with_slots(placed, F.xxhash64(*[F.col(f"`{c}`") for c in keep], "text_crc32"))
