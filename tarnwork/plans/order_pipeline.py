"""Orders pipeline: extract tables, partition orders by day, join the details, publish.

Run it with ``python -m tarnwork.plans.order_pipeline --help`` or pass the file
to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.joins import enrich_details
from tarnwork.operators.shape import with_date_parts
from tarnwork.sources.files import (
    publish,
    read_csv,
    read_partitions,
    write_csv,
    write_partitioned,
)
from tarnwork.sources.jdbc import (
    list_jdbc_tables,
    read_jdbc,
    read_jdbc_partitioned,
    write_jdbc,
)

PARTITION_COLUMNS = ("year", "month", "day")

# The columns of the published table.
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "employee_id",
    "order_date",
    "required_date",
    "shipped_date",
    "ship_via",
    "freight",
    "ship_name",
    "ship_address",
    "ship_city",
    "ship_region",
    "ship_postal_code",
    "ship_country",
)
DETAIL_COLUMNS = ("unit_price", "quantity", "discount")


def extract_day(source: DataFrame, date_col: str, day: str, out: str) -> None:
    """Replace one day's partition (``day`` is ``yyyyMMdd``).

    The day is a range on the bare date column, so the source can apply it.
    """
    start = datetime.strptime(day, "%Y%m%d")
    rows = source.where(
        (F.col(date_col) >= F.lit(start.date()))
        & (F.col(date_col) < F.lit((start + timedelta(days=1)).date()))
    )
    write_partitioned(with_date_parts(rows, date_col), out, PARTITION_COLUMNS)


def extract_all(source: DataFrame, date_col: str, out: str) -> None:
    """Write every day's partition in a single job."""
    write_partitioned(with_date_parts(source, date_col), out, PARTITION_COLUMNS)


def extract_table(source: DataFrame, out: str) -> None:
    """Replace a table's snapshot."""
    write_partitioned(source, out)


def build_order_details(
    orders: DataFrame,
    details: DataFrame,
    order_key: str = "order_id",
    order_columns: Sequence[str] = ORDER_COLUMNS,
    detail_key: str = "order_id",
    detail_columns: Sequence[str] = DETAIL_COLUMNS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The published table: order columns and detail columns, one row per detail.

    Spark splits the details of a huge order at run time; ``hot``, the list of such
    orders from :func:`tarnwork.operators.joins.hot_keys`, salts them instead.
    """
    return enrich_details(
        orders.select(*order_columns), details, order_key, detail_key, detail_columns, hot
    )


def orders_query(day: str | None = None) -> str:
    """The query the database runs for the orders of one day, or all orders."""
    columns = ", ".join(ORDER_COLUMNS)
    if day is None:
        return f"select {columns} from orders"
    date = datetime.strptime(day, "%Y%m%d").strftime("%Y-%m-%d")
    return f"select {columns} from orders where order_date = '{date}'"


def run(
    spark: SparkSession,
    url: str,
    tables_path: str,
    details_csv: str,
    result_csv: str,
    result_table: str = "published_order_lines",
    day: str | None = None,
    strides: int = 8,
    result_mode: str = "append",
    result_files: int | None = None,
    stride_columns: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """The whole pipeline for one day, or for all days.

    ``stride_columns`` names a numeric or date column of each large table besides
    ``orders``, by which it is read in ``strides`` parallel parts; a table that is not
    named comes over one connection into one task. ``result_files`` is the number of
    CSV files (None: as many as the result has partitions).

    The loop runs once per source table, each turn a distributed job of its own.
    """
    orders_path = f"{tables_path}/orders"
    orders_schema = None
    for table in [row[0] for row in list_jdbc_tables(spark, url, **options).collect()]:
        if table != "orders":
            column = (stride_columns or {}).get(table)
            if column:
                rows = read_jdbc_partitioned(spark, url, table, column, strides, **options)
            else:
                rows = read_jdbc(spark, url, table, **options)
            extract_table(rows, f"{tables_path}/{table}")
            continue
        source = read_jdbc_partitioned(
            spark, url, orders_query(day), "order_id", strides, **options
        )
        orders_schema = with_date_parts(source, "order_date").schema
        if day:
            extract_day(source, "order_date", day, orders_path)
        else:
            extract_all(source, "order_date", orders_path)
    # With the schema given, a first run on a day without orders reads as empty.
    orders = read_partitions(spark, orders_path, day=day, schema=orders_schema)
    result = build_order_details(orders, read_csv(spark, details_csv))
    return publish(
        result,
        partial(write_jdbc, url=url, table=result_table, mode=result_mode, **options),
        partial(write_csv, path=result_csv, n_files=result_files),
    )


def main(argv: Sequence[str] | None = None) -> None:
    """User and password come from the environment variables named on the command line."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--url", required=True)
    parser.add_argument("--driver", default="org.postgresql.Driver")
    parser.add_argument("--user-env", default="DB_USER")
    parser.add_argument("--password-env", default="DB_PASSWORD")
    parser.add_argument("--tables-path", required=True)
    parser.add_argument("--details-csv", required=True)
    parser.add_argument("--result-csv", required=True)
    parser.add_argument("--day", help="yyyyMMdd; all days when left out")
    args = parser.parse_args(argv)

    from tarnwork.session import build_session

    run(
        build_session("order-pipeline"),
        args.url,
        args.tables_path,
        args.details_csv,
        args.result_csv,
        day=args.day,
        driver=args.driver,
        user=os.environ[args.user_env],
        password=os.environ[args.password_env],
    )


if __name__ == "__main__":
    main()
