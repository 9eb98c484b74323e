"""The Jaccard join against all pairs, on odd, generated and given documents."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import setjoin
from tarnwork.llm.components import components
from tarnwork.llm.setjoin import jaccard_components

from .conftest import plain


def brute(rows, threshold=80):
    def shingles(text):
        words = (text or "").encode().lower().split()
        if len(words) < 5:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    sets = [shingles(text) for _, text in rows]
    where, common = defaultdict(list), Counter()
    for i, found in enumerate(sets):
        for x in found:
            common.update((j, i) for j in where[x])
            where[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in common.items():
        if 100 * n >= threshold * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[root(i)] += [doc_id] if doc_id is not None else []
    return sorted(
        ((d, len(sets[i]), min(ids[root(i)], default=None)) for i, (d, _) in enumerate(rows)), key=repr
    )


def test_odd_documents(odd, odd_rows):
    assert plain(jaccard_components(odd)) == brute([r[:2] for r in odd_rows])


def test_given_documents(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert plain(jaccard_components(sample)) == brute(rows)


def test_chains_of_edits_in_small_blocks(spark, monkeypatch):
    """Families of texts with many edits: links, near misses, and chains of links."""
    monkeypatch.setattr(setjoin, "LIST_BLOCK", 8)
    monkeypatch.setattr(setjoin, "BUCKET_BYTES", 4096)
    draw = random.Random(5)
    rows = []
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(draw.choice([6, 40, 90]))]
        for _ in range(40):
            copy = list(words)
            for _ in range(draw.randrange(5)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, "common passage of a few words here " + f"end{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert plain(jaccard_components(docs)) == brute(rows)
    assert plain(jaccard_components(docs, threshold=60)) == brute(rows, 60)


def test_small_documents(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randrange(12)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert plain(jaccard_components(docs)) == brute(rows)


def test_no_documents_and_other_names(spark, nothing, odd_rows):
    assert jaccard_components(nothing).collect() == []
    renamed = spark.createDataFrame(
        [(r[0], r[1], 1, "x") for r in odd_rows], "id bigint, body string, n int, sign string"
    )
    assert plain(jaccard_components(renamed, "id", "body")) == brute([r[:2] for r in odd_rows])


def test_packed_numbers_come_back():
    numbers = np.sort(np.random.RandomState(0).randint(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (setjoin._unpack_sorted(setjoin._pack_sorted(numbers)) == numbers).all()
    assert len(setjoin._unpack_sorted(setjoin._pack_sorted(numbers[:0]))) == 0


@pytest.mark.parametrize(
    "edges", [[], [(1, 2), (2, 3), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)], [(5, 5)]]
)
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = plain(components(spark.createDataFrame(edges, "a int, b int")))
    assert got == sorted(((x, root(x)) for x in parent), key=repr)


def test_batches_of_more_texts_than_a_block_holds(spark):
    """80,000 short texts in one batch: sizes do not depend on the session's batch size."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    try:
        docs = spark.range(80_000).coalesce(1).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 50_000).alias("text")
        )
        out = jaccard_components(docs)
        assert out.where("n_shingles <> 1").count() == 0
        assert out.where("component_id <> doc_id % 50000").count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
