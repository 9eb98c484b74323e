from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.drift import bucketize, psi, psi_components, with_share

#: Waiting minutes. Shares by bin: 2/8 3/8 2/8 1/8, and 1/8 3/8 4/8 0.
SPLITS = [0.0, 10.0, 20.0, 40.0, 80.0]
REFERENCE = [3.0, 7.0, 12.0, 15.0, 18.0, 25.0, 30.0, 60.0]
CURRENT = [5.0, 12.0, 14.0, 16.0, 22.0, 28.0, 33.0, 35.0]
#: (1/8 - 2/8) ln(1/2) + (4/8 - 2/8) ln 2; one-sided bins count nothing.
TOTAL = 0.375 * math.log(2)


@pytest.fixture(scope="module")
def scores(spark):
    data = [(s, "reference") for s in REFERENCE] + [(s, "current") for s in CURRENT]
    return spark.createDataFrame(data, "minutes double, season string")


def components(df, **kwargs):
    return psi_components(df, "minutes", "season", SPLITS, "reference", "current", **kwargs)


def test_psi_components(scores):
    got = {r.bin: tuple(r)[1:] for r in components(scores).collect()}
    expected = {
        0: (0.25, 0.125, 0.125 * math.log(2)),
        1: (0.375, 0.375, 0),
        2: (0.25, 0.5, 0.25 * math.log(2)),
        3: (0.125, 0, 0),
    }
    assert got.keys() == expected.keys()
    for b, values in expected.items():
        assert got[b] == pytest.approx(values)


def test_psi_total(scores):
    total = psi(scores, "minutes", "season", SPLITS, "reference", "current").collect()
    assert [r.psi for r in total] == [pytest.approx(TOTAL)]


def test_psi_of_equal_periods_is_zero(scores):
    both = scores.where("season = 'reference'").select(
        "minutes", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("p")
    )
    assert psi(both, "minutes", "p", SPLITS, "a", "b").first().psi == 0


def test_psi_epsilon_counts_one_sided_bins(scores):
    floor = psi(scores, "minutes", "season", SPLITS, "reference", "current", epsilon=1e-4)
    assert floor.first().psi > TOTAL + 0.5


def test_psi_of_one_period_or_nothing(scores):
    one = scores.where("season = 'current'")
    assert psi(one, "minutes", "season", SPLITS, "reference", "current").first().psi == 0
    none = scores.limit(0)
    assert psi(none, "minutes", "season", SPLITS, "reference", "current").first().psi == 0


def test_values_outside_the_splits(spark):
    df = spark.createDataFrame(
        [(-1.0, "a"), (90.0, "b"), (None, "a"), (float("nan"), "b")], "v double, p string"
    )
    assert {r.bin for r in bucketize(df, "v", SPLITS).collect()} == {None}
    opened = {r.v: r.bin for r in bucketize(df, "v", SPLITS, open_ended=True).collect()}
    assert opened[-1.0] == 0 and opened[90.0] == 5 and opened[None] is None


def test_bucketize_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 4.0, 10.0, 40.0, 80.0)], "v double")
    assert [r.bin for r in bucketize(df, "v", SPLITS).orderBy("v").collect()] == [0, 0, 1, 3, 3]
    with pytest.raises(ValueError):
        bucketize(df, "v", [1.0, 1.0, 2.0])


def test_bucketize_equals_ml_bucketizer(spark):
    from pyspark.ml.feature import Bucketizer

    df = spark.range(1000).select((F.col("id") / 999.0 * 80).alias("v")).where("v <= 80")
    ml = Bucketizer(splits=SPLITS, inputCol="v", outputCol="want").transform(df)
    assert bucketize(ml, "v", SPLITS).where("bin != cast(want as int)").isEmpty()


def test_with_share(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 3), (None, "z", 2), ("o", "w", 0)], "g string, k string, n long"
    )
    assert rows(with_share(df, "n", "g"), "k", "share") == [
        ("w", None),
        ("x", 0.25),
        ("y", 0.75),
        ("z", 1.0),
    ]
