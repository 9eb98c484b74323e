from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from .conftest import plain
from .test_rules_mix_shards import brute_rules, expected_targets
from .test_setjoin import brute as brute_groups

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert left == {d for d, r in rows.items() if brute_rules(r.text)[-1]}

    groups = brute_groups([(d, rows[d].text) for d in sorted(left)])
    single = corpus_pipeline.near_duplicates(spark, kept, FOLDER)
    left = {d for d, _, first in groups if d == first}
    assert {r.doc_id for r in single.collect()} == left and single.count() == len(left)

    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = corpus_pipeline.decontaminate(spark, single, FOLDER)
    now = {r.doc_id for r in clean.collect()}
    leaked = {d for d in left if any(i in " ".join(rows[d].text.split()) for i in items)}
    assert leaked and now <= left - leaked and len(left - leaked - now) <= 2

    mixed = corpus_pipeline.mix_sources(spark, clean, FOLDER)
    assert mixed.columns == docs.columns
    sizes, taken = Counter(), Counter()
    for d in now:
        sizes[rows[d].source] += len(rows[d].text.split())
    for r in mixed.collect():
        assert tuple(r) == tuple(rows[r.doc_id])
        taken[r.source] += len(r.text.split())
    largest = max(len(rows[d].text.split()) for d in now)
    for source, target in expected_targets(sizes, corpus_pipeline.WEIGHTS).items():
        assert abs(taken[source] - target) <= largest

    out = corpus_pipeline.shard(spark, mixed, FOLDER).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed.collect())
    for s in range(corpus_pipeline.SHARDS):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert plain(corpus_pipeline.run(spark, FOLDER)) == plain(docs)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("which", ["odd", "nothing"])
def test_stages_take_odd_documents(spark, request, which):
    docs = request.getfixturevalue(which).withColumn("size", F.lit(1)).withColumn("n_words", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "sharding":
            assert out.columns == docs.columns
        assert out.count() <= 4 * docs.count()
    assert corpus_pipeline.near_duplicates(spark, docs.where("doc_id = 17"), FOLDER).count() == min(1, docs.count())


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    """One id with two texts, near copies without an id, and rows that repeat."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (None, a + " z"), (None, a + " y"), (3, b + " t"), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(0))
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (2, b), (4, None), (5, "")], key=repr)
