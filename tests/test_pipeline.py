from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnwork.plans import order_pipeline as pipeline
from tarnwork.sources.files import read_csv, read_partitions


@pytest.fixture
def shop(spark, tmp_path, monkeypatch):
    """A database stand-in: tables are DataFrames, JDBC calls are answered from them."""
    text = ("customer_id", "ship_name", "ship_address", "ship_city", "ship_region",
            "ship_postal_code", "ship_country")
    orders = spark.createDataFrame(
        [(11066, date(1998, 5, 1)), (11067, date(1998, 5, 4)), (11068, date(1998, 5, 4)),
         (11069, date(1998, 5, 4)), (10248, date(1996, 7, 4))],
        "order_id smallint, order_date date",
    )
    orders = orders.withColumns(
        {c: F.lit(c) for c in text}
        | {c: F.col("order_date") for c in ("required_date", "shipped_date")}
        | {c: F.lit(1).cast("smallint") for c in ("employee_id", "ship_via")}
        | {"freight": F.lit(2.5).cast("float"), "not_extracted": F.lit(0)}
    )
    tables = {"orders": orders, "region": spark.createDataFrame([(1, "East")], "id int, name string")}
    written = []

    def read(session, url, query, *stride, **options):
        assert options["password"] == "secret"
        if query in tables:
            return tables[query]
        df = orders.select(*pipeline.ORDER_COLUMNS)
        if "where" in query:
            df = df.where(F.col("order_date") == query.split("'")[1])
        return df

    monkeypatch.setattr(pipeline, "read_jdbc", read)
    monkeypatch.setattr(pipeline, "read_jdbc_partitioned", read)
    monkeypatch.setattr(
        pipeline,
        "list_jdbc_tables",
        lambda session, url, **o: session.createDataFrame([(t,) for t in tables], "tablename string"),
    )
    monkeypatch.setattr(
        pipeline, "write_jdbc", lambda df, url, table, mode, **o: written.append((table, mode, df.count()))
    )
    details = [(11067, 9.8, 2), (11067, 1.0, 1), (11069, 5.0, 3), (10248, 4.0, 9), (99999, 1.0, 1)]
    spark.createDataFrame(
        [(str(o), str(p), str(q), "0") for o, p, q in details],
        "order_id string, unit_price string, quantity string, discount string",
    ).coalesce(1).write.option("header", True).csv(str(tmp_path / "details"))
    return tmp_path, written


def run(spark, path, **options):
    return pipeline.run(
        spark,
        "jdbc:none",
        str(path / "tables"),
        str(path / "details"),
        str(path / "result"),
        password="secret",
        **options,
    )


def test_one_day(spark, shop, rows):
    path, written = shop
    result = run(spark, path, day="19980504")
    assert result.columns == [*pipeline.ORDER_COLUMNS, *pipeline.DETAIL_COLUMNS]
    assert rows(result, "order_id", "unit_price") == [(11067, "1.0"), (11067, "9.8"), (11069, "5.0")]
    assert written == [("published_order_lines", "append", 3)]
    assert read_csv(spark, str(path / "result")).count() == 3
    extracted = read_partitions(spark, str(path / "tables" / "orders"))
    assert {r.day for r in extracted.select("day").distinct().collect()} == {19980504}
    assert extracted.count() == 3
    assert spark.read.parquet(str(path / "tables" / "region")).count() == 1


def test_all_days_then_one_day_again(spark, shop):
    path, written = shop
    assert run(spark, path, result_mode="overwrite").count() == 4
    assert run(spark, path, day="19980504").count() == 3
    assert read_partitions(spark, str(path / "tables" / "orders")).count() == 5
    assert [w[1:] for w in written] == [("overwrite", 4), ("append", 3)]


def test_named_tables_are_read_in_strides(spark, shop, monkeypatch):
    path, _ = shop
    strides = []
    plain = pipeline.read_jdbc_partitioned

    def read(session, url, query, column, n, **options):
        strides.append((query.split()[0], column, n))
        return plain(session, url, query, column, n, **options)

    monkeypatch.setattr(pipeline, "read_jdbc_partitioned", read)
    run(spark, path, strides=3, stride_columns={"region": "id"}, result_files=2)
    assert ("region", "id", 3) in strides and len(list((path / "result").glob("*.csv"))) == 2


def test_day_without_orders(spark, shop):
    path, _ = shop
    assert run(spark, path, day="19990101").count() == 0
    run(spark, path)
    assert run(spark, path, day="19990101").count() == 0


def test_extract_day_pushes_a_date_range(spark, tmp_path):
    source = str(tmp_path / "s")
    date_column = F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("d")
    spark.range(10).select("id", date_column).write.parquet(source)
    pipeline.extract_day(spark.read.parquet(source), "d", "20200103", str(tmp_path / "o"))
    written = read_partitions(spark, str(tmp_path / "o")).select("id", "day")
    assert [tuple(r) for r in written.collect()] == [(2, 20200103)]


def test_orders_query():
    assert pipeline.orders_query("19980504").endswith("from orders where order_date = '1998-05-04'")
    assert pipeline.orders_query().endswith("from orders")
    with pytest.raises(ValueError):
        pipeline.orders_query("19980504' or 1=1")
