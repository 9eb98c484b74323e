"""Reshaping: nested columns, maps, unpivot and pivot, JSON and form text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.functions.columns import date_part_ints, form_entries
from tarnwork.operators.joins import as_list


def zip_columns(
    df: DataFrame, fields: Mapping[str, Sequence[str]], out: str, keep_arrays: bool = False
) -> DataFrame:
    """Numbered columns as one array of structs, position by position.

    ``{"height": ["height_1", "height_2"], "kind": ["kind_1", "kind_2"]}`` gives
    ``array<struct<height,kind>>`` of length two. ``keep_arrays`` also adds each
    field's own array under the field's name.
    """
    lengths = {len(columns) for columns in fields.values()}
    if len(lengths) != 1:
        raise ValueError("every field needs the same number of columns")
    rows = [
        F.struct(*[F.col(columns[i]).alias(name) for name, columns in fields.items()])
        for i in range(lengths.pop())
    ]
    added = {}
    if keep_arrays:
        added = {name: F.array(*columns) for name, columns in fields.items()}
    return df.withColumns({**added, out: F.array(*rows)})


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    name: str = "measure",
    value: str = "value",
) -> DataFrame:
    """One row per measure column; NULL values are kept."""
    return df.unpivot(list(ids), list(measures), name, value)


def pivot_by_rules(
    df: DataFrame,
    ids: Sequence[str],
    statistic: str,
    measures: Sequence[str],
    rules: Mapping[tuple[str, str], str],
    keep: Sequence[str] | None = None,
    default: str | None = "except",
) -> DataFrame:
    """Turn (statistic, measure) cells into named columns, one row per ``ids``.

    ``rules`` maps (statistic, measure) to an output column; cells without a
    rule go to ``default``, or are dropped when that is None. ``keep`` limits
    the statistics. When several cells meet in one output cell, the first
    non-NULL one by (measure order, statistic) wins.

    The labels are known from the rules, so neither an unpivot nor a job that
    looks for pivot values is needed: each label is one conditional aggregate.
    """
    rows = df if keep is None else df.where(F.col(statistic).isin(list(keep)))
    known = [m for m in measures]
    labels = sorted({label for (_, m), label in rules.items() if m in known})
    if default is not None and default not in labels:
        labels = sorted([*labels, default])

    def belongs(measure: str, label: str):
        explicit = [s for (s, m), target in rules.items() if m == measure and target == label]
        condition = F.col(statistic).isin(explicit) if explicit else F.lit(False)
        if label == default:
            ruled = [s for (s, m) in rules if m == measure]
            other = ~F.col(statistic).isin(ruled) if ruled else F.lit(True)
            condition = condition | other | F.col(statistic).isNull()
        return condition

    def best_of_row(label: str):
        # Measures are tried in order, so the first hit is the row's best cell.
        return F.coalesce(
            *[
                F.when(
                    belongs(m, label) & F.col(m).isNotNull(),
                    F.struct(
                        F.lit(order).alias("order"),
                        F.col(statistic).alias("statistic"),
                        F.col(m).alias("cell"),
                    ),
                )
                for order, m in enumerate(known)
            ]
        )

    picked = rows.groupBy(*ids).agg(
        *[F.min(best_of_row(label)).alias(f"_cell_{i}") for i, label in enumerate(labels)]
    )
    return picked.select(
        *ids, *[F.col(f"_cell_{i}")["cell"].alias(label) for i, label in enumerate(labels)]
    )


def aggregate_to_map(
    df: DataFrame,
    group: str | Sequence[str],
    key: str,
    value: str,
    out: str = "totals",
    last: str | None = None,
    last_out: str = "last_date",
) -> DataFrame:
    """Per group, a map from key to summed value, and the latest ``last``.

    Sums per (group, key) come first, so only one entry per distinct key reaches
    the group. NULL keys have no place in a map and are left out.
    """
    groups = as_list(group)
    sums = [F.sum(value).alias("_sum")]
    if last:
        sums.append(F.max(last).alias("_last"))
    per_key = df.groupBy(*groups, key).agg(*sums)
    entry = F.when(F.col(key).isNotNull(), F.struct(F.col(key), F.col("_sum")))
    result = [F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(out)]
    if last:
        result.append(F.max("_last").alias(last_out))
    return per_key.groupBy(*groups).agg(*result)


def explode_map(df: DataFrame, col: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per map entry; a NULL or empty map gives none."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(col).alias(key, value))


def collect_joined(
    df: DataFrame, group: str | Sequence[str], cols: Sequence[str], sep: str = ";"
) -> DataFrame:
    """Distinct non-NULL values per group, sorted and joined; ``''`` when none."""
    return df.groupBy(*as_list(group)).agg(
        *[
            F.concat_ws(sep, F.array_sort(F.collect_set(c)).cast("array<string>")).alias(c)
            for c in cols
        ]
    )


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Schema of the JSON objects in a text column, merged over all rows.

    One distributed aggregate inside the JVM; only the merged schema text comes
    back. Text that is not a JSON object is ignored.
    """
    rows = df.select(F.try_parse_json(F.col(col).cast("string")).alias("v"))
    is_object = F.schema_of_variant("v").startswith("OBJECT<")
    merged = rows.select(F.schema_of_variant_agg(F.when(is_object, F.col("v")))).first()[0]
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"column {col!r} holds no JSON object")
    return _struct_from_variant_schema(merged)


def _struct_from_variant_schema(text: str) -> T.StructType:
    """The column types JSON text inference gives for a merged variant schema."""
    # Quoted field names may contain any word, so only unquoted parts change.
    parts = text.split("`")
    parts[::2] = [
        p.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")
        for p in parts[::2]
    ]

    def plain(data_type: T.DataType) -> T.DataType:
        if isinstance(data_type, T.StructType):
            return T.StructType(
                [T.StructField(f.name, plain(f.dataType), True) for f in data_type.fields]
            )
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(plain(data_type.elementType), True)
        if isinstance(data_type, T.DecimalType) and data_type.scale > 0:
            return T.DoubleType()
        return data_type

    return plain(T.DataType.fromDDL("`".join(parts)))


def parse_json_column(
    df: DataFrame, col: str, schema: T.StructType | str | None = None, out: str | None = None
) -> DataFrame:
    """Replace a JSON text column by a struct (or add it as ``out``).

    Without a schema it is inferred from the column itself. NULL text gives a
    NULL struct, malformed text a struct of NULLs.
    """
    schema = schema or infer_json_schema(df, col)
    return df.withColumn(out or col, F.from_json(F.col(col).cast("string"), schema))


def parse_form(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Replace a form body by a map of its entries (or add it as ``out``)."""
    return df.withColumn(out or col, form_entries(F.col(col)))


def with_date_parts(df: DataFrame, col: str) -> DataFrame:
    """Add integer ``year``, ``month`` and ``day`` columns."""
    return df.withColumns(date_part_ints(F.col(col)))
