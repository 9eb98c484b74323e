"""Joins on inequalities: overlapping intervals, and counts under two inequalities.

Neither compares every pair of rows, and neither is planned as a nested-loop join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.joins import ROWS_PER_SALT, as_list, fits_broadcast, hot_keys, salted_join
from tarnwork.operators.ordered import Pieces, running_totals
from tarnwork.scratch import materialize

#: Bins of a level are so many times as wide as those of the level below.
BASE = 8
#: Branches of a node in the tree over the places of a piece.
RADIX = 16


def as_number(column: str, kind: T.DataType) -> Column:
    """A number in the order of the column: days of dates, microseconds of times."""
    value = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):  # without a time zone, so whatever the session's is
        of_day = (F.hour(value) * 60 + F.minute(value)).cast("long") * 60_000_000
        seconds = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
        return F.unix_date(value.cast("date")).cast("long") * 86_400_000_000 + of_day + seconds
    if isinstance(kind, T.NumericType):
        return value
    raise ValueError(f"column {column!r} is neither a number, a date nor a time")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: str | Sequence[str] = (),
    width: float | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Pairs of rows whose spans (start and end, both included) overlap, keys being equal.

    Spans are numbers, dates or times. Rows with a NULL key or bound, and spans that end
    before they start, match nothing. The right side's keys are not repeated; its other
    names must not occur on the left.

    The line is cut into bins on several levels, each ``BASE`` times wider than the last
    (``width`` is the narrowest, by default the average length of all spans). A span's own
    level is the first whose bins are as wide as the span, so it lies in two of them at
    most. Two spans meet on the wider one's level, where the shorter one is listed too, and
    the pair is reported by the bin in which the later one starts. Bins that hold many
    rows of the left side are salted.
    """
    keys = as_list(on)
    kept = [c for c in right.columns if c not in keys]
    clash = set(kept) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    sides = []
    for df, span, columns, name in ((left, left_span, left.columns, "l"), (right, right_span, kept, "r")):
        start, end = (as_number(c, df.schema[c].dataType) for c in span)
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, *span]])
        rows = df.where(known).select(
            *keys, F.struct(*columns).alias(name), start.alias(f"{name}_start"), end.alias(f"{name}_end"),
        ).where(F.col(f"{name}_start") <= F.col(f"{name}_end"))
        # Rows are numbered so that exact copies get salts of their own.
        numbered = rows.withColumn(f"{name}_row", F.monotonically_increasing_id())
        sides.append(materialize(numbered, f"spans-{name}"))
    lengths = [
        s.agg(F.sum((F.col(f"{n}_end") - F.col(f"{n}_start")).cast("double")), F.count(F.lit(1))).first()
        for s, n in zip(sides, "lr")
    ]
    if width is None:
        width = sum(x[0] or 0.0 for x in lengths) / max(1, sum(x[1] for x in lengths)) or 1.0
    levels = []  # of each side, those on which it has spans of its own: a few numbers
    for i, n in enumerate("lr"):
        length = (F.col(f"{n}_end") - F.col(f"{n}_start")).cast("double")
        own = F.ceil(F.log(F.greatest(length / width, F.lit(1.0))) / math.log(BASE)).cast("int")
        sides[i] = sides[i].withColumn(f"{n}_own", own)
        levels.append(sorted(r[0] for r in sides[i].select(f"{n}_own").distinct().collect()))

    def binned(side: DataFrame, n: str, own: list[int], other: list[int]) -> DataFrame:
        at = sorted({*own, *other})
        wanted = F.array(*[F.lit(x) for x in at]).cast("array<int>")
        used = F.array(*[F.lit(x) for x in other]).cast("array<int>")
        mine = F.col(f"{n}_own")
        # Its own level, and the other side's wider ones.
        chosen = F.filter(wanted, lambda x: (x == mine) | ((x > mine) & F.array_contains(used, x)))
        rows = side.withColumn("level", F.explode(chosen))
        size = width * F.pow(F.lit(float(BASE)), F.col("level"))
        first, last = (F.floor(F.col(f"{n}_{x}") / size).cast("long") for x in ("start", "end"))
        return rows.withColumn("bin", F.explode(F.sequence(first, last)))

    one = binned(sides[0], "l", levels[0], levels[1])
    two = binned(sides[1], "r", levels[1], levels[0]).drop("r_row")
    place = [*keys, "level", "bin"]
    hot = hot_keys(one, place, rows_per_salt=rows_per_salt)
    pairs = salted_join(one, two, place, "inner", hot=hot, salt_by=["l_row", "bin"])
    size = width * F.pow(F.lit(float(BASE)), F.col("level"))
    later = F.floor(F.greatest("l_start", "r_start") / size).cast("long")
    met = pairs.where(
        ((F.col("l_own") == F.col("level")) | (F.col("r_own") == F.col("level")))
        & (F.col("l_start") <= F.col("r_end"))
        & (F.col("r_start") <= F.col("l_end"))
        & (F.col("bin") == later)
    )
    return met.select("l.*", *[F.col("r")[c].alias(c) for c in kept])


_BEFORE = {"<": (False, False), "<=": (False, True), ">": (True, False), ">=": (True, True)}


def count_both(
    left: DataFrame,
    right: DataFrame,
    first: tuple[str, str, str],
    second: tuple[str, str, str],
    on: str | Sequence[str] = (),
    out: str = "n_matches",
    n_pieces: int | None = None,
) -> DataFrame:
    """Add to each left row how many right rows satisfy two inequalities.

    ``first`` and ``second`` are (right column, operator, left column), such as
    ``("day", "<", "day")``; keys ``on`` have to be equal. NULL satisfies nothing.

    All rows are cut into pieces by the first inequality. Those of one piece are counted
    in it (:func:`_count_in_piece`). For the rest all rows are cut again, by the second
    inequality, into bands. The right rows of a smaller piece and a smaller band are
    counted as a table of a row per piece and band, those of a smaller piece and the same
    band in the band. So each row is dealt out twice, whatever the number of rows, and no
    pair of rows is ever formed.
    """
    keys = as_list(on)
    (r_x, op_x, l_x), (r_y, op_y, l_y) = first, second
    for op in (op_x, op_y):
        if op not in _BEFORE:
            raise ValueError("operators are <, <=, >, >=")
    down_x, equal_x = _BEFORE[op_x]
    # The right rows that count for the second inequality come first, in its order.
    down_y, equal_y = _BEFORE[op_y]
    stored = materialize(left.withColumn("_d_id", F.monotonically_increasing_id()), "left-rows")
    names = [f"k{i}" for i in range(len(keys))]

    def side(df: DataFrame, x: str, y: str, id_: Column, is_left: bool) -> DataFrame:
        chosen = df.select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(x).alias("x"), F.col(y).alias("y"),
            id_.cast("long").alias("id"),
            # At equal values the row that has to see the other one comes later.
            F.lit(int(is_left == equal_x)).alias("turn_x"), F.lit(int(is_left == equal_y)).alias("turn_y"),
        )
        return chosen.dropna(how="any", subset=[*names, "x", "y"])

    both = side(stored, l_x, l_y, F.col("_d_id"), True).unionByName(
        side(right, r_x, r_y, F.lit(None), False)
    )
    by_x = F.col("x").desc() if down_x else F.col("x").asc()
    by_y = F.col("y").desc() if down_y else F.col("y").asc()
    pieces = Pieces(both, names, [by_x, "turn_x"], n_pieces)
    # Rows that are equal in all this are of one side, and do not count each other.
    place = F.dense_rank().over(Window.partitionBy("_o_piece").orderBy(*names, by_x, "turn_x"))
    placed = pieces.rows.select(
        "_o_piece", *names, "y", "turn_y", "id", (place - 1).cast("long").alias("place")
    )
    order = [by_y, F.col("turn_y")]
    found = _count_in_piece(materialize(placed, "places"), names, order, "place")
    rows = found.select(F.col("_o_piece").alias("x_piece"), *names, "y", "turn_y", "id", "n")
    if pieces.rows.where("_o_piece > 0").isEmpty():
        found = rows.where("id is not null").select("id", F.col("n").alias(out))
    else:
        bands = Pieces(rows, names, order, n_pieces)
        below = _count_below(bands.rows, names)
        found = _count_in_piece(bands.rows, names, order, "x_piece").where("id is not null")
        side = F.broadcast(below) if fits_broadcast(below) else below
        found = found.withColumnRenamed("_o_piece", "band").join(side, [*names, "x_piece", "band"]).select(
            "id", (F.col("n") + F.col("n_below")).alias(out)
        )
    return stored.join(found, F.col("_d_id") == F.col("id"), "left").select(
        *left.columns, F.coalesce(out, F.lit(0)).cast("long").alias(out)
    )


def _count_in_piece(rows: DataFrame, keys: list[str], order: list[Column], place: str) -> DataFrame:
    """Rows with ``n`` more: right rows of the key and piece at smaller places, earlier in the order.

    Places form a tree with ``RADIX`` branches per node: the places before a given one are
    whole branches, left of its own, of the nodes above it. In each node, running totals in
    the order count the right rows up to each branch. A level is a sort within the piece.
    """
    last = rows.agg(F.max(place)).first()[0] or 0
    counted, asking = F.col("id").isNull(), F.col("id").isNotNull()
    out = rows.drop("_o_row").repartition("_o_piece")
    if "n" not in rows.columns:
        out = out.withColumn("n", F.lit(0).cast("long"))
    size = 1
    while size <= last:
        node = F.floor(F.col(place) / (size * RADIX)).alias("node")
        branch = F.pmod(F.floor(F.col(place) / size), F.lit(RADIX)).cast("int").alias("branch")
        so_far = Window.partitionBy("node", "_o_piece", *keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0
        )
        out = out.select("*", node, branch).withColumns(
            {
                f"b{k}": F.sum(F.when(counted & (F.col("branch") < k), 1).otherwise(0)).over(so_far)
                for k in range(1, RADIX)
            }
        )
        left_of = reduce(
            lambda a, k: a.when(F.col("branch") == k, F.col(f"b{k}")),
            range(2, RADIX), F.when(F.col("branch") == 1, F.col("b1")),
        ).otherwise(0)
        out = out.select(
            *[c for c in rows.columns if c not in ("_o_row", "n")],
            F.when(asking, F.col("n") + left_of).alias("n"),
        )
        size *= RADIX
    return out


def _count_below(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, x_piece, band, n_below``: right rows of smaller pieces and smaller bands; stored.

    The pieces of a key stand next to each other, and so do its bands.
    """
    rows = rows.select(*keys, "x_piece", F.col("_o_piece").alias("band"), "id")
    ends = rows.groupBy(*keys).agg(
        *[f(c).alias(f"{n}_{c}") for c in ("x_piece", "band") for n, f in (("a", F.min), ("z", F.max))]
    )
    grid = ends.withColumn("x_piece", F.explode(F.sequence("a_x_piece", "z_x_piece"))).withColumn(
        "band", F.explode(F.sequence("a_band", "z_band"))
    )
    place = [*keys, "x_piece", "band"]
    cells = rows.where("id is null").select(*place, F.lit(1).alias("one")).unionByName(
        grid.select(*place, F.lit(0).alias("one"))
    ).groupBy(*place).agg(F.sum("one").alias("n_cell"))
    # A piece's right rows in smaller bands, then those of all smaller pieces.
    lower = running_totals(cells, [*keys, "x_piece"], "band", {"n_lower": F.col("n_cell")}, include_row=False)
    earlier = Window.partitionBy(*keys, "band").orderBy("x_piece").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n_lower").over(earlier), F.lit(0))
    return materialize(lower.select(*place, below.alias("n_below")), "below")
