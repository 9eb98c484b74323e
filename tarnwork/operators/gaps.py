"""Series without gaps: a table function that fills the missing slots of time.

Rows are first combined to one per key and slot. Slots are cut into chunks, and each
(key, chunk) is filled on its own, chunks without any row included: it also gets the last
row before its chunk and the first one after it, so neither a hot key nor a long gap is
one task's work. Each row knows the one that follows in its chunk, so the table function
takes Arrow batches of any rows, in any order, and returns batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tarnwork.operators.joins import as_list
from tarnwork.operators.ordered import neighbours
from tarnwork.scratch import materialize

FILLS = ("zero", "previous", "linear")
#: Slots in a chunk, that one key fills in one task.
CHUNK_SLOTS = 4096
#: Rows in a batch that the table function returns.
BATCH_SLOTS = 16_384


class FillSlots:
    """Table function over Arrow batches of ``keys..., _chunk, _slot, measures..., _next``.

    ``_next`` is the following row in the chunk, ``_slot`` and all linear measures of it, or
    NULL. Returns ``keys..., _slot, measures..., filled``: each row's slots up to the next
    one, rows outside the chunk are only looked at. :meth:`of` says how each measure is
    filled and how many slots a chunk has. Linear measures are doubles.
    """

    fills: tuple[str, ...] = ()
    chunk_slots = CHUNK_SLOTS

    @classmethod
    def of(cls, rows: StructType, fills: Sequence[str], chunk_slots: int):
        """The table function for these rows; Spark 4.1 has no ``analyze`` for Arrow batches."""
        bound = type("BoundFillSlots", (cls,), {"fills": tuple(fills), "chunk_slots": chunk_slots})
        return F.arrow_udtf(bound, returnType=cls.schema(rows, fills))

    @staticmethod
    def schema(rows: StructType, fills: Sequence[str]) -> StructType:
        """What is returned for such rows, whose linear measures may still be of any number type."""
        fields = list(rows)
        n_keys = len(fields) - 2 - len(fills)
        if n_keys < 0 or [f.name for f in fields[n_keys : n_keys + 2]] != ["_chunk", "_slot"]:
            raise ValueError("rows must be keys, _chunk, _slot and one column per fill")
        given = list(zip(fields[n_keys + 2 :], fills))
        for f, h in given:
            if h != "previous" and not isinstance(f.dataType, NumericType):
                raise ValueError(f"{f.name} is not a number and cannot be filled by {h}")
        measures = [StructField(f.name, DoubleType() if h == "linear" else f.dataType) for f, h in given]
        return StructType([*fields[:n_keys], fields[n_keys + 1], *measures, StructField("filled", BooleanType())])

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_keys = rows.num_columns - 3 - len(self.fills)
        names = [*rows.schema.names[:n_keys], *rows.schema.names[n_keys + 1 : -1], "filled"]
        keys, (chunk, slot), values = rows.columns[:n_keys], rows.columns[n_keys : n_keys + 2], rows.columns[n_keys + 2 : -1]
        next_at, *next_values = rows.column(rows.num_columns - 1).flatten()
        later = dict(zip((i for i, h in enumerate(self.fills) if h == "linear"), next_values))

        at, start = slot.to_numpy(), chunk.to_numpy() * self.chunk_slots
        until = pc.coalesce(next_at, pc.add(slot, 1)).to_numpy(zero_copy_only=False)
        first = np.maximum(at, start)
        ends = np.cumsum(np.maximum(np.minimum(until, start + self.chunk_slots) - first, 0))
        total = int(ends[-1]) if len(ends) else 0
        for low in range(0, total, BATCH_SLOTS):
            place = np.arange(low, min(low + BATCH_SLOTS, total))
            of = np.searchsorted(ends, place, side="right")
            # Places count from the row's first slot, which the rows before it end at.
            made = first[of] + place - np.where(of > 0, ends[of - 1], 0)
            filled = made > at[of]
            share = ((made - at[of]).astype("float64"), (until[of] - at[of]).astype("float64"))
            row = pa.array(of)
            measures = [
                _linear(v.take(row), later[i].take(row), filled, share) if h == "linear" else _constant(h, v.take(row), filled)
                for i, (h, v) in enumerate(zip(self.fills, values))
            ]
            columns = [*(k.take(row) for k in keys), pa.array(made), *measures, pa.array(filled)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _constant(how: str, before: pa.Array, filled: np.ndarray) -> pa.Array:
    if how == "previous":
        return before
    zero = Decimal(0) if pa.types.is_decimal(before.type) else 0
    return pc.if_else(pa.array(filled), pa.scalar(zero, before.type), before)


def _linear(before: pa.Array, after: pa.Array, filled: np.ndarray, share: tuple) -> pa.Array:
    known, end = (v.fill_null(0.0).to_numpy() for v in (before, after))
    unknown, no_end = (v.is_null().to_numpy(zero_copy_only=False) for v in (before, after))
    with np.errstate(all="ignore"):
        between = known + (end - known) * share[0] / share[1]
    return pa.array(np.where(filled, between, known), mask=unknown | (filled & no_end))


def _whole_seconds(df: DataFrame, time: str) -> Column:
    """Seconds since 1970, downwards; local times without a zone as if there were none."""
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        since = F.col(time) - F.lit("1970-01-01").cast("timestamp_ntz")
        part = lambda unit: F.extract(F.lit(unit), since)
        minutes = part("DAY").cast("long") * 1440 + part("HOUR") * 60 + part("MINUTE")
        return minutes * 60 + F.floor(part("SECOND"))
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / 1_000_000)


def _slot_start(df: DataFrame, time: str, seconds: Column) -> Column:
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        days, rest = F.floor(seconds / 86400).cast("int"), F.pmod(seconds, F.lit(86400)).cast("int")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)
    return F.timestamp_seconds(seconds)


def fill_gaps(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    step: int,
    measures: Mapping[str, tuple[Column, str]],
    chunk_slots: int = CHUNK_SLOTS,
) -> DataFrame:
    """``keys, time, measures, filled``: a row for each slot between a key's first and last.

    A slot is ``step`` seconds long, counted from 1970, and named by its start. ``measures``
    are ``{"n": (F.count("*"), "zero")}``: an aggregate of the slot's rows and what a slot
    without rows gets: ``zero``, the ``previous`` slot's value, or the value ``linear``
    between the slots before and after (a double; NULL if one of them is). NULL keys are
    a key; rows without a time are left out. The time keeps its type, a date becomes a timestamp.
    """
    keys = as_list(keys)
    unknown = sorted({how for _, how in measures.values()} - set(FILLS))
    if unknown or not measures:
        raise ValueError(f"measures need a fill of {FILLS}, got {unknown}")
    if step < 1 or chunk_slots < 1:
        raise ValueError("step and chunk_slots must be at least 1")
    reserved = ("_chunk", "_slot", "_next")
    taken = {*keys, time, "filled"} & {*measures} or {c for c in (*keys, *measures) if c in reserved}
    if taken:
        raise ValueError(f"names given twice or reserved: {sorted(taken)}")
    seconds = _whole_seconds(df, time)
    slot = ((seconds - F.pmod(seconds, F.lit(step))) / step).cast("long")
    known = df.where(F.col(time).isNotNull()).groupBy(*keys, slot.alias("_slot"))
    grain = known.agg(*[a.alias(name) for name, (a, _) in measures.items()])
    chunk = ((F.col("_slot") - F.pmod("_slot", F.lit(chunk_slots))) / chunk_slots).cast("long")
    layout = [*keys, "_chunk", "_slot", *measures]
    grain = grain.withColumn("_chunk", chunk).select(*layout)
    how = {name: h for name, (_, h) in measures.items()}
    fill_slots = FillSlots.of(grain.schema, [*how.values()], chunk_slots)
    linear = [name for name, h in how.items() if h == "linear"]
    grain = materialize(grain.withColumns({name: F.col(name).cast("double") for name in linear}), "slots")

    row = F.struct("_slot", *measures)
    ends = grain.groupBy(*keys, "_chunk").agg(F.min_by(row, "_slot").alias("_head"), F.max_by(row, "_slot").alias("_tail"))
    ends = neighbours(
        ends, keys, "_chunk", {"_prior": ("_tail", -1), "_later": ("_head", 1), "_next": ("_chunk", 1)}
    )
    ends = materialize(ends, "chunk-ends")
    around = ends.select(*keys, "_chunk", F.explode(F.array("_prior", "_later")).alias("_row"))
    between = ends.where(F.col("_next") > F.col("_chunk") + 1).select(
        *keys,
        F.explode(F.sequence(F.col("_chunk") + 1, F.col("_next") - 1)).alias("_chunk"),
        F.array("_tail", "_later").alias("_rows"),
    )
    empty = between.select(*keys, "_chunk", F.explode("_rows").alias("_row"))
    beyond = around.where("_row is not null").unionByName(empty).select(*keys, "_chunk", "_row.*")
    rows = grain.unionByName(beyond.select(*layout))
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("_slot")
    rows = rows.select(*layout, F.lead(F.struct("_slot", *linear)).over(in_chunk).alias("_next"))
    filled = fill_slots(rows.asTable())
    start = _slot_start(df, time, F.col("_slot") * step)
    return filled.select(*keys, start.alias(time), *measures, "filled")
