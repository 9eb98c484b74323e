"""Keyed state: deduplication, snapshot merge and upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    ROWS_PER_SALT,
    as_list,
    comparable_columns,
    spread_null_keys,
)
from tarnwork.operators.windows import max_rows
from tarnwork.scratch import materialize


def dedup_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    ties: str = "one",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Keep the newest row per key set.

    ``ties="one"`` keeps exactly one row: the highest ``order_by`` (NULL last),
    further ties broken by the remaining columns, so the choice never depends on
    partitioning. Spark keeps one candidate per key on the map side, before the
    shuffle, so a hot key costs one row per map task.

    ``ties="all"`` keeps every row that equals the key's newest ``order_by``
    column; rows where it is NULL are dropped, see
    :func:`tarnwork.operators.windows.max_rows`.
    """
    key_columns, order = as_list(keys), as_list(order_by)
    if ties == "one":
        rest = [c for c in comparable_columns(df) if c not in key_columns and c not in order]
        newest_first = Window.partitionBy(*key_columns).orderBy(
            *[F.col(c).desc_nulls_last() for c in [*order, *rest]]
        )
        return (
            df.withColumn("_row", F.row_number().over(newest_first))
            .where(F.col("_row") == 1)
            .drop("_row")
        )
    if ties != "all":
        raise ValueError("ties must be 'one' or 'all'")
    if len(order) != 1:
        raise ValueError("ties='all' takes a single order column")
    return max_rows(df, key_columns, order[0], rows_per_salt)


def _typed_like(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns of ``new`` in the types of ``old``, written once.

    A merge reads the new rows several times and has to see the same rows each
    time, whatever they are computed from.
    """
    typed = [
        _exact(F.col(c), c, new.schema[c].dataType, old.schema[c].dataType).alias(c) for c in columns
    ]
    return materialize(new.select(*typed), "merge-source")


#: Text that says a number; a whole number is written without leading zeros.
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def _same_text(text: Column, cast: Column, want: T.DataType) -> Column:
    """Whether a text says no more and no less than the value it was cast to.

    Numbers with a fraction and times may be written in several ways; everything else only
    as Spark writes it. White space, leading zeros, or a time of day for a date are changes.
    """
    if isinstance(want, (T.FloatType, T.DoubleType)):
        return text.rlike(_NUMBER)
    if isinstance(want, T.DecimalType):
        widest = T.DecimalType(38, min(want.scale + 6, 18))
        return text.rlike(_NUMBER) & (text.try_cast(widest) == cast.try_cast(widest)) & ~text.rlike(
            rf"\.[0-9]{{{widest.scale + 1},}}"
        )
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return text.rlike(_TIME)
    return cast.cast("string") == text


def _exact(value: Column, name: str, have: T.DataType, want: T.DataType) -> Column:
    """The value in another type; one that would change or be lost raises.

    Unlike a plain cast, this does not depend on the session's ANSI setting. For text see
    :func:`_same_text`.
    """
    if have == want or isinstance(have, T.NullType):
        return value.cast(want)
    cast = value.try_cast(want)
    if isinstance(have, T.StringType):
        back = _same_text(value, cast, want)
    else:
        back = cast.try_cast(have).eqNullSafe(value)
    same = cast.isNotNull() & back
    message = f"a value of column {name!r} does not fit type {want.simpleString()}"
    return F.when(value.isNull() | same, cast).otherwise(F.raise_error(F.lit(message)).cast(want))


@dataclass(frozen=True)
class SourceSize:
    rows: int
    text_bytes: int
    most_per_key: int

    def is_small(self, rows: int) -> bool:
        return self.rows <= rows and self.text_bytes <= BROADCAST_BYTES


def _measure(stored: DataFrame, keys: Sequence[str]) -> SourceSize:
    """Rows, bytes as text, and rows of the most frequent non-NULL key, in one job."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = stored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("_bytes"),
    )
    found = per_key.agg(F.sum("_n"), F.sum("_bytes"), F.max(F.when(known, F.col("_n")))).first()
    return SourceSize(*[x or 0 for x in found])


def _merge(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    matched: Mapping[str, Column],
    inserted: Mapping[str, Column],
    small: bool,
) -> DataFrame:
    """``old`` with matching rows changed, plus the rows of ``new`` without a match.

    ``new`` is stored and has the types of ``old``. ``matched`` and ``inserted``
    are written over the columns of ``old`` and the ``_new_*`` columns of ``new``.

    Where ``new`` was measured and is ``small``, it is broadcast and ``old`` is not
    shuffled.
    Otherwise both sides are shuffled; as a left join and an anti join, unlike as
    a full outer join, Spark can still split a part of ``old`` that is too big for
    one task.
    """
    types = {c: old.schema[c].dataType for c in old.columns}
    new_keys = [f"_new_{k}" for k in keys]
    prefixed = new.select(*[F.col(c).alias(f"_new_{c}") for c in new.columns])
    right = spread_null_keys(prefixed, new_keys, "_new_spread")
    left = spread_null_keys(old, keys, "_spread")
    on = [F.col(a) == F.col(b) for a, b in zip([*keys, "_spread"], [*new_keys, "_new_spread"])]
    right = right.withColumn("_hit", F.lit(True))
    kept = left.join(F.broadcast(right) if small else right, on, "left").select(
        *[matched.get(c, F.col(c)).cast(types[c]).alias(c) for c in old.columns]
    )

    # Keys alone tell which new rows are unmatched; each key leaves a map task once.
    old_keys = old.select(*keys)
    if small:
        wanted = F.broadcast(new.select(*keys))
        old_keys = old_keys.join(wanted, list(keys), "left_semi").distinct()
        old_keys = F.broadcast(old_keys)
    else:
        old_keys = old_keys.dropna(how="any").distinct()
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in new_keys])
    unmatched = prefixed.where(no_null).join(
        old_keys, [F.col(a) == F.col(b) for a, b in zip(new_keys, keys)], "left_anti"
    )
    added = unmatched.unionByName(prefixed.where(~no_null)).select(
        *[inserted.get(c, F.lit(None)).cast(types[c]).alias(c) for c in old.columns]
    )
    return kept.unionByName(added)


def merge_snapshot(
    history: DataFrame,
    updates: DataFrame,
    keys: str | Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """History brought up to date: the update's value where it has one, else the old one.

    Keys found on one side only are kept; the columns are those of ``history``.
    A NULL in the update never erases an old value (:func:`upsert` writes it).
    Rows with a NULL key match nothing and are kept from both sides. The updates
    are stored and counted first, see :func:`_merge`.
    """
    key_columns = as_list(keys)
    shared = [c for c in history.columns if c in updates.columns and c not in key_columns]
    stored = _typed_like(history, updates, [*key_columns, *shared])
    return _merge(
        history,
        stored,
        key_columns,
        matched={c: F.coalesce(f"_new_{c}", c) for c in shared},
        inserted={c: F.col(f"_new_{c}") for c in [*key_columns, *shared]},
        small=_measure(stored, key_columns).is_small(broadcast_rows),
    )


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Non-NULL key values that occur more than once."""
    key_columns = as_list(keys)
    known = df.select(*key_columns).dropna(how="any")
    return known.groupBy(*key_columns).count().where(F.col("count") > 1).select(*key_columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Merge ``source`` into ``target`` and return the new state.

    Matching rows take the source's ``update_cols``, even where they are NULL.
    Source rows without a match are inserted with ``insert_cols``; columns not
    listed become NULL. Target rows without a match stay. Both lists default to
    all columns the source has. A key that occurs twice in the source raises. The
    source is stored and counted first, see :func:`_merge`.
    """
    key_columns = as_list(keys)
    available = [c for c in target.columns if c in source.columns]
    updates = [c for c in (update_cols or available) if c not in key_columns]
    inserts = list(insert_cols or available)
    unknown = [c for c in [*updates, *inserts] if c not in available]
    if unknown:
        raise ValueError(f"columns missing from target or source: {sorted(set(unknown))}")
    needed = [c for c in available if c in {*key_columns, *updates, *inserts}]
    stored = _typed_like(target, source, needed)
    size = _measure(stored, key_columns)
    if size.most_per_key > 1:
        raise ValueError(f"source holds duplicate keys in {key_columns}")
    return _merge(
        target,
        stored,
        key_columns,
        matched={
            c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in updates
        },
        inserted={c: F.col(f"_new_{c}") for c in inserts},
        small=size.is_small(broadcast_rows),
    )
