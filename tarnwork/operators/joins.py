"""Joins: skew-safe salted joins, group statistics joined back, order details.

A join key that holds a large part of all rows would land in one task. The
operators here add a *salt* to the join key: rows of a hot key are spread over
several salts and the matching rows of the other side are repeated once per
salt. The salt is a hash of the row itself, never a random number, so a task
that is run again after an executor loss sends every row to the same place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.scratch import materialize

#: Rows one salt is meant to carry. A key with more of them is hot.
ROWS_PER_SALT = 5_000_000


#: A side is broadcast only after it was found to hold no more than this.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.VariantType)


def comparable_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed and ordered."""
    return [f.name for f in df.schema.fields if not _has_map(f.dataType)]


def hot_keys(
    df: DataFrame,
    on: str | Sequence[str],
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Keys with more than ``rows_per_salt`` rows, and how many salts each needs.

    No more than one row in ``rows_per_salt`` comes out. NULL counts as a key. The
    list is stored, so that its uses do not count again.
    """
    keys = as_list(on)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > rows_per_salt).select(
        *keys, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")
    )
    return materialize(hot, "hot-keys")


def fits_broadcast(
    stored: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a stored table is small enough to send to every executor.

    Rows are counted first; only a table that passes has its text size summed, so
    neither a long nor a wide table gets through.
    """
    if stored.count() > max_rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return (stored.agg(size).first()[0] or 0) <= max_bytes


def _with_salt_count(
    df: DataFrame, keys: list[str], hot: DataFrame, small: bool
) -> DataFrame:
    """Add ``_salts``: NULL for ordinary keys. ``small``: ``hot`` was sized and fits."""
    renamed = hot.select(
        *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], F.col("_salts")
    )
    match = [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)]
    return df.join(F.broadcast(renamed) if small else renamed, _all(match), "left").drop(
        *[f"_hot_{i}" for i in range(len(keys))]
    )


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    n_salts: int | None = None,
    hot: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    null_safe: bool = False,
    hint: str | None = None,
) -> DataFrame:
    """Same rows as ``fact.join(dim, on, how)``, with the skewed fact side spread out.

    Either every key is spread over ``n_salts``, or, with ``hot`` from
    :func:`hot_keys`, only the keys listed there. A key listed twice counts once, with
    its larger number of salts; the list is broadcast only if it is found small, else
    joined like any table. ``salt_by`` names the columns
    that tell fact rows apart; the default is all of them. Exact copies of a row
    share a salt. ``null_safe`` lets NULL match NULL. ``hint="merge"`` rules out
    a broadcast; without it Spark broadcasts ``dim`` when it is small enough,
    and no salt is then needed.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports 'left' and 'inner'")
    if (n_salts is None) == (hot is None):
        raise ValueError("give either n_salts or hot")
    if n_salts is not None and n_salts < 1:
        raise ValueError("n_salts must be positive")
    keys = as_list(on)
    clash = (set(fact.columns) & set(dim.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    row_hash = F.xxhash64(*(salt_by or comparable_columns(fact)))
    if hot is not None:
        small = fits_broadcast(hot)
        hot = hot.groupBy(*keys).agg(F.max("_salts").alias("_salts"))
    if hot is None:
        left = fact.withColumn("_salt", F.pmod(row_hash, F.lit(n_salts)).cast("int"))
        right, copies = dim, F.lit(n_salts)
    else:
        left = _with_salt_count(fact, keys, hot, small)
        left = left.withColumn(
            "_salt", F.coalesce(F.pmod(row_hash, F.col("_salts")).cast("int"), F.lit(0))
        ).drop("_salts")
        right, copies = _with_salt_count(dim, keys, hot, small), F.coalesce("_salts", F.lit(1))

    kept = [c for c in dim.columns if c not in keys]
    right = right.select(
        *[F.col(k).alias(f"_dim_{i}") for i, k in enumerate(keys)],
        *kept,
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("_dim_salt"),
    )
    if hint:
        right = right.hint(hint)
    pairs = [(F.col(k), F.col(f"_dim_{i}")) for i, k in enumerate(keys)]
    match = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    joined = left.join(right, _all([*match, F.col("_salt") == F.col("_dim_salt")]), how)
    return joined.select(*fact.columns, *kept)


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    by: str | Sequence[str],
    rows_per_salt: int = ROWS_PER_SALT,
    part: str | None = None,
) -> DataFrame:
    """Join per-group results back to the rows they came from.

    The rows of a hot group are spread over salts, unlike in a window over the
    whole group, which would put them in one task. Exact copies are told apart by the
    input partition they stand in, or by the column ``part`` that says so. NULL is a
    group like any other. Groups missing from ``groups`` are dropped.
    """
    keys = as_list(by)
    told = rows if part else rows.withColumn("_part", F.spark_partition_id())
    joined = salted_join(
        told,
        groups,
        keys,
        how="inner",
        hot=hot_keys(rows, keys, rows_per_salt=rows_per_salt),
        salt_by=comparable_columns(told),
        null_safe=True,
    )
    return joined if part else joined.drop("_part")


def spread_null_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add a join helper column: the hash of the keys, or of the whole row where a key is NULL.

    Rows with a NULL key match nothing, but a shuffle would still send all of
    them to one task. With this column in the join condition they scatter. Keys
    of both sides need the same types.
    """
    missing = F.col(keys[0]).isNull()
    for key in keys[1:]:
        missing = missing | F.col(key).isNull()
    scatter = F.xxhash64(*comparable_columns(df))
    return df.withColumn(name, F.when(missing, scatter).otherwise(F.xxhash64(*keys)))


def enrich_details(
    orders: DataFrame,
    details: DataFrame,
    order_key: str = "order_id",
    detail_key: str = "order_id",
    detail_columns: Sequence[str] = ("unit_price", "quantity", "discount"),
    hot: DataFrame | None = None,
) -> DataFrame:
    """One row per detail row whose order exists, with the order's columns.

    The detail key may be text (a CSV column); text that is not a number matches
    nothing instead of failing the job. The join is a plain one, which Spark
    splits at run time where one order holds very many details; ``hot``, from
    :func:`hot_keys` over ``orders``' key in the details, salts such orders
    instead.
    """
    key_type = orders.schema[order_key].dataType
    right = details.select(F.col(detail_key).try_cast(key_type).alias(order_key), *detail_columns)
    if hot is not None:
        joined = salted_join(
            right.where(F.col(order_key).isNotNull()), orders, order_key, "inner", hot=hot
        )
    else:
        joined = orders.join(right, order_key, "inner")
    return joined.select(*orders.columns, *detail_columns)
