from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.shape import (
    aggregate_to_map,
    collect_joined,
    explode_map,
    infer_json_schema,
    parse_form,
    parse_json_column,
    pivot_by_rules,
    unpivot_measures,
    with_date_parts,
    zip_columns,
)

METERS = [
    ("lake", 2020, "day", 7, 3, "2020-02-01"),
    ("lake", 2020, "day", 7, 4, "2020-02-09"),
    ("lake", 2020, "day", 19, 5, "2020-01-15"),
    ("hill", 2021, None, 7, 2, "2021-05-05"),
    ("hill", 2021, "night", 19, 9, "2021-03-03"),
]
METERS_SCHEMA = "site string, year int, tariff string, hour int, kwh long, read_on string"

HARVEST = [
    ("yield", "west", "rye", 4.0, 3.5), ("yield", "west", "oats", 2.0, None),
    ("rain", "west", "rye", 310.0, 290.0), ("rain", "east", "rye", 150.0, 175.0),
    ("frost", "east", "rye", 12.0, 15.0), ("hail", "east", "rye", 1.0, 2.0),
    ("frost", "east", "oats", None, 6.0),
]
HARVEST_SCHEMA = "measure string, zone string, crop string, now double, before double"
FIELD = ["zone", "crop"]
SEASONS = ["now", "before"]
RULES = {("yield", "now"): "tons", ("yield", "before"): "tons_before", ("rain", "now"): "rain"}


def test_zip_columns(spark, rows):
    df = spark.createDataFrame(
        [(4, 9, None, 12, "oak", "", "ash", "elm")],
        "height_1 int, height_2 int, height_3 int, height_4 int, "
        "kind_1 string, kind_2 string, kind_3 string, kind_4 string",
    )
    fields = {f: [f"{f}_{i}" for i in (1, 2, 3, 4)] for f in ("height", "kind")}
    zipped = zip_columns(df, fields, "trees", keep_arrays=True)
    assert zipped.schema["trees"].dataType.simpleString() == "array<struct<height:int,kind:string>>"
    row = zipped.first()
    assert [tuple(t) for t in row.trees] == [(4, "oak"), (9, ""), (None, "ash"), (12, "elm")]
    assert row.height == [4, 9, None, 12]
    back = zipped.selectExpr("inline(trees)")
    assert rows(back, "kind") == [("",), ("ash",), ("elm",), ("oak",)]
    with pytest.raises(ValueError):
        zip_columns(df, {"a": ["height_1"], "b": []}, "out")


def test_aggregate_to_map_and_back(spark, rows):
    df = spark.createDataFrame(METERS, METERS_SCHEMA)
    maps = aggregate_to_map(df, ["site", "year", "tariff"], "hour", "kwh", out="hours", last="read_on")
    got = {(r.site, r.year, r.tariff): (r.hours, r.last_date) for r in maps.collect()}
    assert got == {
        ("lake", 2020, "day"): ({7: 7, 19: 5}, "2020-02-09"),
        ("hill", 2021, None): ({7: 2}, "2021-05-05"),
        ("hill", 2021, "night"): ({19: 9}, "2021-03-03"),
    }
    exploded = explode_map(maps, "hours")
    assert exploded.count() == 4
    assert rows(exploded.where("site = 'lake'"), "key", "value") == [(19, 5), (7, 7)]


def test_aggregate_to_map_sums_repeated_keys_and_skips_null_keys(spark):
    df = spark.createDataFrame(
        [("g", "a", 1), ("g", "a", 2), ("g", None, 5), ("h", None, 1)], "g string, k string, v int"
    )
    got = {r.g: r.totals for r in aggregate_to_map(df, "g", "k", "v").collect()}
    assert got == {"g": {"a": 3}, "h": {}}


def test_unpivot_keeps_null(spark, rows):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    assert rows(unpivot_measures(df, ["id"], ["a", "b"])) == [(1, "a", 2.0), (1, "b", None)]


def test_pivot_by_rules(spark):
    df = spark.createDataFrame(HARVEST, HARVEST_SCHEMA)
    pivoted = pivot_by_rules(df, FIELD, "measure", SEASONS, RULES)
    assert pivoted.columns == [*FIELD, "except", "rain", "tons", "tons_before"]
    got = {(r[0], r[1]): tuple(r)[2:] for r in pivoted.collect()}
    assert got == {
        ("west", "rye"): (290.0, 310.0, 4.0, 3.5),
        ("west", "oats"): (None, None, 2.0, None),
        ("east", "rye"): (12.0, 150.0, None, None),
        ("east", "oats"): (6.0, None, None, None),
    }


def test_pivot_by_rules_with_keep_list_and_without_default(spark):
    df = spark.createDataFrame(HARVEST, HARVEST_SCHEMA)
    rules = {("frost", "before"): "frost_before", ("hail", "now"): "hail"}
    kept = pivot_by_rules(df, FIELD, "measure", SEASONS, rules, keep=["frost", "hail"])
    got = {(r[0], r[1]): tuple(r)[2:] for r in kept.collect()}
    assert kept.columns[2:] == ["except", "frost_before", "hail"]
    assert got == {("east", "rye"): (12.0, 15.0, 1.0), ("east", "oats"): (None, 6.0, None)}
    plain = pivot_by_rules(df, FIELD, "measure", SEASONS, rules, default=None)
    assert plain.columns[2:] == ["frost_before", "hail"]


def test_unpivot_then_pivot_is_identity(spark, rows):
    df = spark.createDataFrame(
        [(1, "s", 1.0, 2.0), (2, "s", 3.0, None)], "id int, s string, a double, b double"
    )
    pivoted = pivot_by_rules(
        df, ["id"], "s", ["a", "b"], {("s", "a"): "a", ("s", "b"): "b"}, default=None
    )
    assert rows(pivoted, "id", "a", "b") == rows(df, "id", "a", "b")


def test_pivot_needs_one_shuffle(spark):
    df = spark.createDataFrame(HARVEST, HARVEST_SCHEMA)
    pivoted = pivot_by_rules(df, FIELD, "measure", SEASONS, RULES)
    plan = pivoted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Expand" not in plan


def test_collect_joined(spark):
    df = spark.createDataFrame(
        [(1, 10, "b"), (1, 9, "a"), (1, 9, "b"), (2, None, None)], "g int, n int, s string"
    )
    got = {r.g: (r.n, r.s) for r in collect_joined(df, "g", ["n", "s"]).collect()}
    assert got == {1: ("9;10", "a;b"), 2: ("", "")}


JSON_ROWS = [(1, '{"k":1}'), (2, '{"k":2.5,"b":[1]}'), (3, "bad"), (4, None)]


def test_infer_json_schema(spark):
    df = spark.createDataFrame(JSON_ROWS, "id long, data string")
    schema = infer_json_schema(df, "data")
    assert schema.simpleString() == "struct<b:array<bigint>,k:double>"


def test_infer_json_schema_matches_json_reader(spark):
    texts = [
        '{"a":{"VOID x":"s","n":null},"d":[{"y":1},{"z":"q"}],"t":true}',
        '{"big":12345678901234567890,"e":[],"m":1,"mixed":1}',
        '{"m":"text","mixed":{"a":1}}',
        "[1,2]",
        "7",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    got = infer_json_schema(df, "data")
    want = spark.read.json(spark.sparkContext.parallelize(texts[:3])).schema
    assert got == want


def test_infer_json_schema_without_objects(spark):
    df = spark.createDataFrame([("bad",), (None,)], "data string")
    with pytest.raises(ValueError):
        infer_json_schema(df, "data")


def test_parse_json_column(spark):
    df = spark.createDataFrame(JSON_ROWS, "id long, data string")
    got = {r.id: r.data for r in parse_json_column(df, "data").collect()}
    assert (got[1].b, got[1].k) == (None, 1.0)
    assert (got[2].b, got[2].k) == ([1], 2.5)
    assert (got[3].b, got[3].k) == (None, None)
    assert got[4] is None
    given = parse_json_column(df, "data", "k string", out="parsed")
    assert given.columns == ["id", "data", "parsed"]
    assert isinstance(given.schema["parsed"].dataType, T.StructType)


def test_parse_form(spark):
    df = spark.createDataFrame(
        [
            (1, "title=foo_1&body=bar&userId=1"),
            (2, "a=1&a=2&b=x=y&c&d=1,2&e="),
            (3, ""),
            (4, None),
        ],
        "id int, body string",
    )
    got = {r.id: r.body for r in parse_form(df, "body").collect()}
    assert got[1] == {"title": "foo_1", "body": "bar", "userId": "1"}
    assert got[2] == {"a": "2", "b": "x=y", "c": None, "d": "1,2", "e": ""}
    assert got[3] == {}
    assert got[4] is None


def test_with_date_parts(spark):
    df = spark.sql("select date'1998-05-04' as d union all select null")
    got = {tuple(r) for r in with_date_parts(df, "d").select("year", "month", "day").collect()}
    assert got == {(1998, 199805, 19980504), (None, None, None)}
    types = [f.dataType for f in with_date_parts(df, "d").schema.fields[1:]]
    assert types == [T.IntegerType()] * 3


def test_date_parts_match_formatted_dates(spark):
    days = F.date_add(F.lit("1970-01-01"), F.col("id").cast("int"))
    df = spark.range(0, 20000, 37).select(days.alias("d"))
    formatted = with_date_parts(df, "d").where(
        (F.col("year") != F.date_format("d", "yyyy").cast("int"))
        | (F.col("month") != F.date_format("d", "yyyyMM").cast("int"))
        | (F.col("day") != F.date_format("d", "yyyyMMdd").cast("int"))
    )
    assert formatted.isEmpty()
