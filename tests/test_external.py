from __future__ import annotations

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tarnwork.operators.external import call_external
from tarnwork.operators.shape import parse_form
from tarnwork.scratch import materialize


def test_every_row_gets_one_outcome(spark, rows):
    def answer(payload, timeout_s):
        assert timeout_s == 1.0 and payload["label"] == f"foo_{payload['id']}"
        if payload["id"] % 10 == 0:
            raise TimeoutError
        return 500 if payload["id"] % 10 == 1 else 201

    df = spark.range(100_000).select("id", F.concat(F.lit("foo_"), "id").alias("label"))
    called = materialize(call_external(df, answer, ["id", "label"], rows_per_task=5000))
    assert called.columns == ["id", "label", "status", "outcome"]
    counts = called.groupBy("outcome", "status").count()
    assert rows(counts) == [("error", 500, 10_000), ("success", 201, 80_000), ("timeout", None, 10_000)]
    assert called.select("id").distinct().count() == 100_000


def test_calls_in_flight_are_bounded(spark, rows):
    def build():
        import threading
        import time

        state = {"open": 0, "most": 0}

        def answer(payload, timeout_s):
            # One state per worker process; each call reports the most seen so far.
            lock = state.setdefault("lock", threading.Lock())
            with lock:
                state["open"] += 1
                state["most"] = max(state["most"], state["open"])
            time.sleep(0.005)
            with lock:
                state["open"] -= 1
            return state["most"]

        return answer

    df = spark.range(0, 200, 1, 1)
    called = call_external(df, build(), ["id"], max_in_flight=4)
    assert called.agg(F.max("status")).first()[0] <= 4


def test_null_and_large_numbers_pass_through(spark, rows):
    def answer(payload, timeout_s):
        return 201 if payload["big"] == 2**62 + 1 else 400

    df = spark.createDataFrame([(2**62 + 1, None), (None, 7)], "big long, small int")
    assert rows(call_external(df, answer, ["big"])) == [
        (2**62 + 1, None, 201, "success"),
        (None, 7, 400, "error"),
    ]
    with pytest.raises(ValueError):
        call_external(df, answer, ["big"], max_in_flight=0)
    with pytest.raises(ValueError):
        call_external(df.withColumn("outcome", F.lit(1)), answer, ["big"])


def test_mistakes_of_the_callback_fail_the_job(spark):
    def answer(payload, timeout_s):
        return payload["no such key"]

    with pytest.raises(PythonException, match="no such key"):
        call_external(spark.range(3), answer, ["id"]).collect()


def test_network_errors_count_as_timeouts(spark, rows):
    def answer(payload, timeout_s):
        raise ConnectionResetError

    assert rows(call_external(spark.range(1), answer, ["id"])) == [(0, None, "timeout")]


def test_the_next_batch_starts_before_the_last_call_ends(spark):
    def answer(payload, timeout_s):
        import time

        if payload["id"] == 0:
            time.sleep(1.0)
        return int(time.time() * 1000) % 1_000_000_000

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = call_external(spark.range(0, 10, 1, 1), answer, ["id"], max_in_flight=2).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    when = {r.id: r.status for r in got}
    assert when[7] < when[0]


def test_response_body_to_map(spark):
    df = spark.createDataFrame([("colour=blue&size=7&n=",)], "body string")
    assert parse_form(df, "body").first().body == {"colour": "blue", "size": "7", "n": ""}
