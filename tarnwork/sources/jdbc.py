"""Database tables over JDBC.

Credentials travel only in the ``options`` of a call (``user``, ``password``,
``driver``); nothing here stores or prints them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")


def _as_relation(table_or_query: str) -> str:
    """A table name as it is; a query as a derived table, so the database runs it."""
    text = table_or_query.strip().rstrip(";")
    if text.startswith("("):
        return text
    if re.match(r"(?i)(select|with)\b", text):
        return f"({text}) q"
    return text


def _identifier(name: str) -> str:
    """A column or schema name that is safe to place in query text."""
    if not (_IDENTIFIER.fullmatch(name) or re.fullmatch(r'"[^"]+"', name)):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, **options) -> DataFrame:
    """A table, or the result of a query the database runs, over one connection."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", _as_relation(table_or_query))
        .load()
    )


def bounds_query(table_or_query: str, column: str) -> str:
    """Smallest and largest value of a column, as one query."""
    name = _identifier(column)
    relation = _as_relation(table_or_query)
    return f"select min({name}) as lo, max({name}) as hi from {relation}"


def partition_options(column: str, low, high, n: int) -> dict[str, object]:
    """Stride options. The bounds only place the strides; rows outside are still read."""
    if n < 1:
        raise ValueError("n must be positive")
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(n),
    }


def read_jdbc_partitioned(
    spark: SparkSession, url: str, table_or_query: str, column: str, n: int, **options
) -> DataFrame:
    """Read in ``n`` parallel strides over ``column``.

    One small query finds the bounds in the same table or query that is read.
    An empty table is read over one connection.
    """
    low, high = read_jdbc(spark, url, bounds_query(table_or_query, column), **options).first()
    if low is None:
        return read_jdbc(spark, url, table_or_query, **options)
    return read_jdbc(
        spark, url, table_or_query, **{**options, **partition_options(column, low, high, n)}
    )


def tables_query(schema: str = "public") -> str:
    """The tables of one schema, from the database's catalog view."""
    return f"select tablename from pg_tables where schemaname = '{_identifier(schema)}'"


def list_jdbc_tables(
    spark: SparkSession, url: str, schema: str = "public", query: str | None = None, **options
) -> DataFrame:
    """Table names of a schema. ``query`` replaces the catalog query for other databases."""
    return read_jdbc(spark, url, query or tables_query(schema), **options)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    max_connections: int = 16,
    **options,
) -> None:
    """Write to a table over at most ``max_connections`` parallel connections.

    Spark merges partitions down to that number, so hand in a stored table
    (``tarnwork.sources.files.publish``), not a plan still to be computed. A task
    that is repeated after its commit appends its rows again: databases that need
    exactly-once should load a staging table and merge from there.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", str(max_connections))
        .mode(mode)
        .save()
    )
