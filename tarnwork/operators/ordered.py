"""Operators over rows in an order within their key: as-of joins, frames, ranks, sessions.

A window over a whole key would put a hot key into one task. Here rows are cut into
consecutive *pieces* by key and order, of about equal size whatever the keys are, and
written once (range bounds come from a sample; every step has to see the same ones).
Rows of one key stand next to each other, so only the first and the last key of a piece
go on in other pieces. Windows run within a piece; what they need from other pieces, a
running sum, the last row, a few neighbours, is worked out over one row per piece.

Order columns ascend, NULL first. Rows that tie are told apart by their number in the
stored input, so exact copies are spread as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.operators.joins import as_list, comparable_columns, fits_broadcast
from tarnwork.scratch import materialize

#: Helper columns; inputs must not have columns that begin like this.
_MARK = "_o_"


def _ordered(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in columns]


class Pieces:
    """Rows of ``df`` in stored pieces, with ``_o_piece`` and ``_o_row``."""

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column],
        n_pieces: int | None = None,
    ):
        """``order`` holds names, ascending, or columns such as ``F.col("t").desc()``."""
        clash = [c for c in df.columns if c.startswith(_MARK)]
        if clash:
            raise ValueError(f"column names taken by this operator: {clash}")
        self.keys = list(keys)
        self.by_order = [*_ordered(order), F.col("_o_row").asc()]
        numbered = materialize(df.withColumn("_o_row", F.monotonically_increasing_id()), "numbered")
        cut = [*_ordered(self.keys), *self.by_order]
        ranged = numbered.repartitionByRange(n_pieces, *cut) if n_pieces else numbered.repartitionByRange(*cut)
        self.rows = materialize(ranged.withColumn("_o_piece", F.spark_partition_id()), "pieces")
        # Without keys all rows have one key.
        self.key = F.struct(F.lit(0).alias("_"), *[F.col(k) for k in self.keys])

    def inside(self) -> Window:
        """Rows of one key within one piece, in order."""
        return Window.partitionBy("_o_piece", *self.keys).orderBy(*self.by_order)

    def borders(self, *extra: Column, rows: DataFrame | None = None) -> DataFrame:
        """A row per piece, stored: ``piece``, structs of its ``first`` and ``last`` key, and
        ``extra`` aggregates over the piece."""
        found = (rows or self.rows).groupBy(F.col("_o_piece").alias("piece")).agg(
            F.min(self.key).alias("first"), F.max(self.key).alias("last"), *extra
        )
        return materialize(found, "borders")

    def with_piece_facts(self, facts: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """Rows with the columns of ``facts`` (stored; one row per ``piece``) beside them."""
        side = F.broadcast(facts) if fits_broadcast(facts) else facts
        rows = self.rows if rows is None else rows
        return rows.join(side, F.col("_o_piece") == F.col("piece")).drop("piece")


def _in_first(pieces: Pieces, value: Column) -> Column:
    """The value where the row's key is the first one of its piece."""
    return F.when(pieces.key == F.col("first"), value)


def _chain(borders: DataFrame) -> DataFrame:
    """Two rows per piece, one for its first key and one for its last: ``key, piece, at``.

    In order of ``piece, at`` within a key, the rows of the piece's last key (``at`` 1) come
    after what reaches into it (``at`` 0). A key has at most two rows per piece it is in.
    """
    heads = borders.select(F.col("first").alias("key"), "*", F.lit(0).alias("at"))
    tails = borders.select(F.col("last").alias("key"), "*", F.lit(1).alias("at"))
    return heads.unionByName(tails)


_EARLIER = lambda: (
    Window.partitionBy("key").orderBy("piece", "at").rowsBetween(Window.unboundedPreceding, -1)
)


# --- as-of join -----------------------------------------------------------------


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    how: str = "left",
    direction: str = "backward",
    allow_equal: bool = True,
    tolerance: Column | None = None,
    n_pieces: int | None = None,
) -> DataFrame:
    """Each left row with the nearest right row of its key, by time.

    ``backward``: the last right row at or before the left row's time; ``forward``: the
    first at or after it. Without ``allow_equal`` a row of the same time does not count.
    ``tolerance`` is the largest distance that still matches. Of right rows of one time,
    the greatest by their remaining columns counts. NULL keys and times match nothing.
    ``how`` is ``left`` or ``inner``. The right side's keys are not repeated; its other
    names must not occur on the left.

    Both sides are cut into pieces together; the last right row of each piece is carried
    on to the next ones of the same key.
    """
    if how not in ("left", "inner") or direction not in ("backward", "forward"):
        raise ValueError("how is 'left' or 'inner', direction 'backward' or 'forward'")
    keys = as_list(on)
    kept = [c for c in right.columns if c not in keys]
    clash = set(kept) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known_left = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, left_time]])
    known_right = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, right_time]])
    time_type = left.schema[left_time].dataType
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"key {k!r} has another type on the right")
    if right.schema[right_time].dataType != time_type:
        raise ValueError("the times have different types")

    # At one time, the side that must see the other comes last.
    sides = {"left": F.lit(1), "right": F.lit(0)} if allow_equal else {"left": F.lit(0), "right": F.lit(1)}
    l_row, r_row = (
        F.struct(*[F.col(c) for c in left.columns]), F.struct(*[F.col(c) for c in kept])
    )
    l_type, r_type = left.select(l_row.alias("x")).schema["x"], right.select(r_row.alias("x")).schema["x"]
    rest = [c for c in comparable_columns(right) if c in kept]
    tie_type = right.select(F.struct(*[F.col(c) for c in rest]).alias("x")).schema["x"].dataType
    names = [f"k{i}" for i in range(len(keys))]
    both = left.where(known_left).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(left_time).alias("time"),
        sides["left"].alias("side"), F.lit(None).cast(tie_type).alias("tie"),
        l_row.alias("l"), F.lit(None).cast(r_type.dataType).alias("r"),
    ).unionByName(
        right.where(known_right).select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(right_time).alias("time"),
            sides["right"].alias("side"), F.struct(*[F.col(c) for c in rest]).alias("tie"),
            F.lit(None).cast(l_type.dataType).alias("l"), r_row.alias("r"),
        )
    )
    backward = direction == "backward"
    time = F.col("time").asc() if backward else F.col("time").desc()
    times = Pieces(both, names, [time, "side", "tie"], n_pieces)
    is_right = F.col("l").isNull()
    place = F.struct(times.key.alias("key"), "_o_last")
    running = times.inside().rowsBetween(Window.unboundedPreceding, 0)
    # A row's number within key and piece, to find the last right row of the last key.
    rows = times.rows.withColumn("_o_last", F.row_number().over(times.inside()))
    last_right = F.max_by(F.struct(times.key.alias("key"), "r"), F.when(is_right, place))
    borders = times.borders(last_right.alias("tail"), rows=rows)
    tail = F.when((F.col("at") == 1) & F.col("tail.key").eqNullSafe(F.col("key")), F.col("tail.r"))
    carried = (
        _chain(borders).withColumn("tail_row", tail)
        .withColumn("carried", F.last("tail_row", ignorenulls=True).over(_EARLIER()))
        .where("at = 0").select("piece", "first", "carried")
    )
    seen = times.rows.withColumn("_o_seen", F.last("r", ignorenulls=True).over(running))
    joined = times.with_piece_facts(materialize(carried, "asof-carried"), seen).where(~is_right)
    match = F.coalesce("_o_seen", _in_first(times, F.col("carried")))
    if tolerance is not None:
        gap = F.col("time") - match[right_time] if backward else match[right_time] - F.col("time")
        match = F.when(gap <= tolerance, match)
    out = joined.select("l", match.alias("r"))
    if how == "inner":
        out = out.where("r is not null")
    out = out.select("l.*", *[F.col("r")[c].alias(c) for c in kept])
    if how == "left":
        unknown = left.where(~known_left).select(
            *left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in kept]
        )
        out = out.unionByName(unknown)
    return out


# --- running aggregates, ranks ----------------------------------------------------


def running_totals(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str | Column],
    sums: Mapping[str, Column],
    include_row: bool = True,
    n_pieces: int | None = None,
) -> DataFrame:
    """Add running sums within the key, up to each row (or only the rows before it).

    ``sums`` names the new columns and what they add up, NULL as nothing; sums over no
    value are 0. Ties are summed in the order of the stored rows. Fractions in binary
    may round differently than in a single window; whole numbers and decimals are exact.
    """
    key_columns = as_list(keys)
    pieces = Pieces(df, key_columns, as_list(order), n_pieces)
    names = list(sums)
    added = {f"_a_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()}
    marked = pieces.rows.withColumns(added)
    ends = pieces.borders()
    # Sums of the piece's last key: the first key's, in later pieces, go on from them.
    of_last = (
        pieces.with_piece_facts(ends, marked).where(pieces.key == F.col("last"))
        .groupBy(F.col("_o_piece").alias("p")).agg(*[F.sum(f"_a_{n}").alias(f"_t_{n}") for n in names])
    )
    borders = materialize(ends.join(of_last, F.col("piece") == F.col("p")).drop("p"), "tails")
    carried = _chain(borders)
    for n in names:
        tail = F.when(F.col("at") == 1, F.col(f"_t_{n}"))
        carried = carried.withColumn(f"_c_{n}", F.sum(tail).over(_EARLIER()))
    carried = materialize(
        carried.where("at = 0").select("piece", "first", *[f"_c_{n}" for n in names]), "carried"
    )
    frame = pieces.inside().rowsBetween(Window.unboundedPreceding, 0 if include_row else -1)
    rows = marked.withColumns(
        {f"_s_{n}": F.coalesce(F.sum(f"_a_{n}").over(frame), F.lit(0)) for n in names}
    )
    joined = pieces.with_piece_facts(carried, rows)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_s_{n}") + F.coalesce(_in_first(pieces, F.col(f"_c_{n}")), F.lit(0))).alias(n)
            for n in names
        ],
    )


def ranks(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    tiles: int | None = None,
    n_pieces: int | None = None,
) -> DataFrame:
    """Add ``row_number``, ``rank``, ``dense_rank``, ``n_rows`` of the key, and ``tile`` of
    ``tiles`` if asked; ``percent_rank`` and ``cume_dist`` follow from them.

    Rows tie where all order columns are equal, NULL being equal to NULL. Their row
    numbers, and with them the tiles, go by the order of the stored rows. A run of ties
    may be longer than a piece: where it began is carried on.
    """
    key_columns, order_columns = as_list(keys), as_list(order)
    pieces = Pieces(df, key_columns, order_columns, n_pieces)
    value = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in order_columns])
    in_key = Window.partitionBy("_o_piece", *key_columns).orderBy(*_ordered(order_columns))
    rows = pieces.rows.withColumns(
        {
            "_o_number": F.row_number().over(pieces.inside()),
            "_o_rank": F.rank().over(in_key),
            "_o_dense": F.dense_rank().over(in_key),
        }
    )
    facts = F.struct("_o_number", "_o_rank", "_o_dense", value.alias("value"))
    by_place = F.struct(pieces.key.alias("key"), "_o_number")
    borders = pieces.borders(
        F.min_by(value, by_place).alias("head_value"), F.max_by(facts, by_place).alias("tail"), rows=rows
    )
    # A key's chain: what lies before the piece's first key (at 0), then its tail (at 1).
    chain = _chain(borders)
    is_tail = F.col("at") == 1
    tail = F.when(is_tail, F.col("tail"))
    chain = chain.withColumn("tail_before", F.last(tail, ignorenulls=True).over(_EARLIER()))
    goes_on = F.coalesce(F.col("tail_before.value").eqNullSafe(F.col("head_value")), F.lit(False))
    # For a piece that lies within one key, the same holds for its tail row.
    whole = F.col("first") == F.col("last")
    chain = chain.withColumn("goes_on", F.when(~is_tail | whole, goes_on).otherwise(F.lit(False)))
    chain = chain.withColumn("before", F.coalesce(F.sum(tail["_o_number"]).over(_EARLIER()), F.lit(0)))
    fresh = F.when(
        is_tail & ~(F.col("goes_on") & (F.col("tail._o_dense") == 1)),
        F.col("before") + F.col("tail._o_rank"),
    )
    own_values = F.when(is_tail, F.col("tail._o_dense") - F.col("goes_on").cast("int"))
    chain = chain.withColumns({"fresh": fresh, "own_values": own_values})
    carried = materialize(
        chain.withColumns(
            {
                "run_start": F.last("fresh", ignorenulls=True).over(_EARLIER()),
                "values_before": F.coalesce(F.sum("own_values").over(_EARLIER()), F.lit(0)),
            }
        ).where("at = 0").select("piece", "first", "before", "goes_on", "run_start", "values_before"),
        "rank-carried",
    )
    joined = pieces.with_piece_facts(carried, rows)
    before = F.coalesce(_in_first(pieces, F.col("before")), F.lit(0))
    on_run = F.coalesce(_in_first(pieces, F.col("goes_on")), F.lit(False))
    shifted = F.coalesce(_in_first(pieces, F.col("values_before")), F.lit(0)) - on_run.cast("int")
    numbered = joined.select(
        *df.columns,
        (F.col("_o_number") + before).alias("row_number"),
        F.when(on_run & (F.col("_o_rank") == 1), F.col("run_start"))
        .otherwise(F.col("_o_rank") + before).cast("long").alias("rank"),
        (F.col("_o_dense") + shifted).alias("dense_rank"),
        "_o_piece",
    )
    return _with_sizes(numbered, df.columns, key_columns, borders, pieces, tiles)


def _with_sizes(
    numbered: DataFrame,
    columns: Sequence[str],
    keys: list[str],
    borders: DataFrame,
    pieces: Pieces,
    tiles: int | None,
) -> DataFrame:
    """Add the number of rows of each key: the piece's own count, or, for keys that go on in
    other pieces, the sum over the chain."""
    border_keys = materialize(_chain(borders).select("key").distinct(), "border-keys")
    side = F.broadcast(border_keys) if fits_broadcast(border_keys) else border_keys
    of_border = pieces.rows.join(side, pieces.key == F.col("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_border")
    )
    of_border = materialize(of_border, "border-sizes")
    side = F.broadcast(of_border) if fits_broadcast(of_border) else of_border
    here = Window.partitionBy("_o_piece", *keys)
    sized = numbered.withColumn("_o_here", F.count(F.lit(1)).over(here))
    sized = sized.join(side, pieces.key == F.col("key"), "left")
    n = F.coalesce("n_border", "_o_here")
    out = sized.select(*columns, "row_number", "rank", "dense_rank", n.alias("n_rows"))
    if not tiles:
        return out
    # The first n mod tiles tiles have one row more than the others.
    small, larger = F.floor(F.col("n_rows") / tiles), F.pmod("n_rows", F.lit(tiles))
    in_larger = larger * (small + 1)
    place = F.col("row_number") - 1
    tile = F.when(place < in_larger, F.floor(place / (small + 1))).otherwise(
        larger + F.floor((place - in_larger) / F.greatest(small, F.lit(1)))
    )
    return out.withColumn("tile", (tile + 1).cast("int"))


# --- sliding frames -----------------------------------------------------------------


def sliding(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    columns: Mapping[str, Column],
    rows: tuple[int, int] | None = None,
    values: tuple | None = None,
    n_pieces: int | None = None,
) -> DataFrame:
    """Add aggregates over a sliding frame within the key.

    ``rows=(a, b)``: from ``a`` rows before to ``b`` rows after the row, ties in the order of
    the stored rows. ``values=(x, y)``: rows whose order value, a number, lies between the
    row's minus ``x`` and plus ``y``; rows without an order value are in no frame and get NULL.
    ``columns`` are aggregates, as for a window. For values of a neighbouring row see
    :func:`neighbours`.

    Pieces get the rows they need from others (their halo); a frame that is wider than a
    piece takes rows from several.
    """
    key_columns, order_columns = as_list(keys), as_list(order)
    bounds = rows if values is None else values
    if (rows is None) == (values is None):
        raise ValueError("give either rows or values")
    if bounds[0] < 0 or bounds[1] < 0:
        raise ValueError("both bounds are distances from the row: neither may be negative")
    if values is not None and len(order_columns) != 1:
        raise ValueError("a frame by values takes a single order column")
    reach = (F.lit(bounds[0]), F.lit(bounds[1]))
    window = Window.partitionBy("_o_target", *key_columns)
    if rows is not None:
        pieces = Pieces(df, key_columns, order_columns, n_pieces)
        wide = _with_halo(pieces, _with_positions(pieces), "_o_pos", reach)
        frame = window.orderBy("_o_pos").rowsBetween(-rows[0], rows[1])
    else:
        value = order_columns[0]
        pieces = Pieces(df.where(F.col(value).isNotNull()), key_columns, order_columns, n_pieces)
        wide = _with_halo(pieces, pieces.rows, value, reach)
        frame = window.orderBy(value).rangeBetween(-values[0], values[1])
    out = wide.withColumns({n: c.over(frame) for n, c in columns.items()})
    out = out.where("_o_target = _o_piece").select(*df.columns, *columns)
    if values is not None:
        types = {n: out.schema[n].dataType for n in columns}
        lost = df.where(F.col(order_columns[0]).isNull())
        out = out.unionByName(lost.select("*", *[F.lit(None).cast(t).alias(n) for n, t in types.items()]))
    return out


def _with_positions(pieces: Pieces) -> DataFrame:
    """Pieces' rows with ``_o_pos``, the row's number within its whole key."""
    rows = pieces.rows.withColumn("_o_number", F.row_number().over(pieces.inside()))
    place = F.struct(pieces.key.alias("key"), "_o_number")
    borders = pieces.borders(F.max(place).alias("tail"), rows=rows)
    tail = F.when(F.col("at") == 1, F.col("tail._o_number"))
    carried = (
        _chain(borders).withColumn("before", F.coalesce(F.sum(tail).over(_EARLIER()), F.lit(0)))
        .where("at = 0").select("piece", "first", "before")
    )
    joined = pieces.with_piece_facts(materialize(carried, "carried"), rows)
    position = F.col("_o_number") + F.coalesce(_in_first(pieces, F.col("before")), F.lit(0))
    return materialize(
        joined.select(*pieces.rows.columns, position.cast("long").alias("_o_pos")), "positions"
    )


def _with_halo(pieces: Pieces, rows: DataFrame, position: str, reach: tuple) -> DataFrame:
    """Rows of each piece (``_o_target``) and those of other pieces within its reach.

    Which pieces need which others is found over the pieces' first and last positions.
    """
    place = F.struct(pieces.key.alias("key"), position)
    ends = materialize(
        rows.where(F.col(position).isNotNull()).groupBy(F.col("_o_piece").alias("piece")).agg(
            F.min(place).alias("low"), F.max(place).alias("high")
        ),
        "piece-ends",
    )
    low, high = F.col(f"low.{position}"), F.col(f"high.{position}")
    # What a piece holds of its first and of its last key.
    wanted = ends.select(
        F.col("piece").alias("target"), F.col("low.key").alias("w_key"),
        (low - reach[0]).alias("w_low"), low.alias("w_high"), F.lit(False).alias("after"),
    ).unionByName(
        ends.select(
            F.col("piece").alias("target"), F.col("high.key").alias("w_key"), high.alias("w_low"),
            (high + reach[1]).alias("w_high"), F.lit(True).alias("after"),
        )
    )
    # A piece's border keys with the positions they have there; inner keys stay inside.
    inner = F.col("low.key") == F.col("high.key")
    held = ends.select(
        F.col("piece").alias("source"), F.col("low.key").alias("h_key"), low.alias("h_low"),
        F.when(inner, high).alias("h_high"),
    ).unionByName(
        ends.where(~inner).select(
            F.col("piece").alias("source"), F.col("high.key").alias("h_key"),
            F.lit(None).cast(ends.select(low).schema[0].dataType).alias("h_low"), high.alias("h_high"),
        )
    )
    meets = (
        (F.col("w_key") == F.col("h_key"))
        & F.when(F.col("after"), F.col("source") > F.col("target")).otherwise(F.col("source") < F.col("target"))
        & F.coalesce(F.col("h_low") <= F.col("w_high"), F.lit(True))
        & F.coalesce(F.col("h_high") >= F.col("w_low"), F.lit(True))
    )
    needs = materialize(
        wanted.join(held, meets).select("source", "target", "w_key", "w_low", "w_high"), "needs"
    )
    side = F.broadcast(needs) if fits_broadcast(needs) else needs
    halo = rows.join(
        side,
        (F.col("_o_piece") == F.col("source"))
        & (pieces.key == F.col("w_key"))
        & F.col(position).between(F.col("w_low"), F.col("w_high")),
    ).select(*rows.columns, F.col("target").alias("_o_target"))
    return rows.withColumn("_o_target", F.col("_o_piece")).unionByName(halo)


def neighbours(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    columns: Mapping[str, tuple[str, int]],
    n_pieces: int | None = None,
) -> DataFrame:
    """Add values of rows before or after: ``{"previous": ("price", -1), "next": ("price", 1)}``.

    Beyond the first or last row of the key they are NULL. Ties are in the order of the
    stored rows.
    """
    before = max([0, *[-n for _, n in columns.values()]])
    after = max([0, *[n for _, n in columns.values()]])
    key_columns = as_list(keys)
    pieces = Pieces(df, key_columns, as_list(order), n_pieces)
    wide = _with_halo(pieces, _with_positions(pieces), "_o_pos", (F.lit(before), F.lit(after)))
    frame = Window.partitionBy("_o_target", *key_columns).orderBy("_o_pos")
    out = wide.withColumns(
        {name: F.lead(c, n).over(frame) if n >= 0 else F.lag(c, -n).over(frame) for name, (c, n) in columns.items()}
    )
    return out.where("_o_target = _o_piece").select(*df.columns, *columns)


# --- sessions -------------------------------------------------------------------------


def sessions(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    gap: Column,
    sums: Mapping[str, Column] | None = None,
    n_pieces: int | None = None,
) -> DataFrame:
    """``keys, start, end, n_rows`` and ``sums`` of the sessions of each key.

    A session is a run of rows with no more than ``gap`` (an interval, or a number for
    numeric times) between one and the next. Rows without a time belong to none; NULL is
    a key like any other. Sums skip NULL and are NULL over nothing.

    Sessions are found within pieces. Only the first and the last one of a piece can go
    on in others; those are merged by a scan over them, at most two rows per piece.
    """
    key_columns, sums = as_list(keys), dict(sums or {})
    marked = df.where(F.col(time).isNotNull()).select(
        *key_columns, time, *[c.alias(f"_a_{n}") for n, c in sums.items()]
    )
    pieces = Pieces(marked, key_columns, [time], n_pieces)
    since = F.lag(time).over(pieces.inside())
    opens = F.coalesce(F.col(time) > since + gap, F.lit(True)).cast("int")
    running = pieces.inside().rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.rows.withColumn("_o_opens", opens).withColumn(
        "_o_session", F.sum("_o_opens").over(running)
    )
    local = materialize(
        numbered.groupBy("_o_piece", *key_columns, "_o_session").agg(
            F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(f"_a_{n}").alias(n) for n in sums],
        ),
        "piece-sessions",
    )
    # The first session of a piece's first key, the last one of its last key.
    place = F.struct(pieces.key.alias("key"), "_o_session")
    ends = materialize(
        local.groupBy(F.col("_o_piece").alias("piece")).agg(
            F.min(place).alias("head"), F.max(place).alias("tail")
        ),
        "session-ends",
    )
    figures = ["start", "end", "n_rows", *sums]
    marked = pieces.with_piece_facts(ends, local).withColumn(
        "_o_border", (place == F.col("head")) | (place == F.col("tail"))
    )
    inner = marked.where("not _o_border").select(*key_columns, *figures)
    border = marked.where("_o_border")
    in_key = Window.partitionBy(*key_columns).orderBy("_o_piece", "_o_session")
    apart = F.coalesce(F.col("start") > F.lag("end").over(in_key) + gap, F.lit(True)).cast("int")
    # Border sessions of one piece that are two stay two: their gap is known.
    merged = (
        border.withColumn("_o_apart", apart)
        .withColumn("_o_run", F.sum("_o_apart").over(in_key.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key_columns, "_o_run")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_rows").alias("n_rows"),
            *[F.sum(n).alias(n) for n in sums],
        )
        .select(*key_columns, *figures)
    )
    return inner.unionByName(merged)
