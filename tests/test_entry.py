from __future__ import annotations

import __spark_entry__ as contract
from tarnwork.plans import catalog


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["day", "n_details", "revenue"]
    assert df.count() > 0


def test_every_query_of_the_catalog_has_an_oracle():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert catalog.queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_queries_leave_the_session_alone(spark):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll
    for name in ("form_body", "extract_day_roundtrip", "salted_join"):
        contract.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll) == before
