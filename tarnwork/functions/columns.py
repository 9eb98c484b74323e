"""Column-level building blocks: dates, bins, form bodies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_part_ints(date: Column) -> dict[str, Column]:
    """``year`` (yyyy), ``month`` (yyyyMM) and ``day`` (yyyyMMdd) as integers.

    Built from integer arithmetic rather than formatted text, so the three
    columns stay cheap inside generated code.
    """
    year = F.year(date)
    month = year * 100 + F.month(date)
    return {"year": year, "month": month, "day": month * 100 + F.dayofmonth(date)}


def bin_index(value: Column, splits: Sequence[float], open_ended: bool = False) -> Column:
    """Index of the interval ``[splits[i], splits[i+1])`` that holds ``value``.

    The last interval is closed on both ends. NULL, NaN and values outside the
    splits get a NULL bin; ``open_ended`` stretches the first and the last
    interval to infinity, so only NULL and NaN are left over.
    """
    bounds = [float(s) for s in splits]
    if open_ended:
        bounds = [b for b in bounds if not math.isinf(b)]
        bounds = [-math.inf, *bounds, math.inf]
    if len(bounds) < 3 or any(a >= b for a, b in zip(bounds, bounds[1:])):
        raise ValueError("splits must be strictly increasing and span at least two bins")
    number = value.cast("double")

    def search(low: int, high: int) -> Column:
        # Binary search written as nested conditions over the inner bounds.
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(number < bounds[middle], search(low, middle - 1)).otherwise(
            search(middle, high)
        )

    inside = ~F.isnan(number) & (number >= bounds[0]) & (number <= bounds[-1])
    return F.when(inside, search(0, len(bounds) - 2))


def form_entries(body: Column) -> Column:
    """``a=1&b=2`` as ``map<string,string>``; the last of repeated names wins.

    Values are not URL-decoded and keep everything after the first ``=``. An
    item without ``=`` gets a NULL value. NULL stays NULL, empty text gives an
    empty map.
    """
    pieces = F.split(body, "&")
    names = F.transform(pieces, _form_name)
    # Text without repeated or empty names needs no per-item work.
    simple = (F.size(F.array_distinct(names)) == F.size(names)) & ~F.array_contains(names, "")
    no_entries = F.array().cast("array<struct<name:string,value:string>>")
    last_wins = F.aggregate(
        F.reverse(F.filter(pieces, lambda item: item != "")),
        no_entries,
        lambda seen, item: F.when(
            F.exists(seen, lambda entry: entry["name"] == _form_name(item)), seen
        ).otherwise(F.array_append(seen, _form_entry(item))),
    )
    return F.when(simple, F.str_to_map(body, F.lit("&"), F.lit("="))).otherwise(
        F.map_from_entries(last_wins)
    )


def _form_name(item: Column) -> Column:
    return F.substring_index(item, "=", 1)


def _form_entry(item: Column) -> Column:
    value = F.substr(item, F.position(F.lit("="), item) + 1)
    return F.struct(
        _form_name(item).alias("name"),
        F.when(F.contains(item, F.lit("=")), value).alias("value"),
    )
