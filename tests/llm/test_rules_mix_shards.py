from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import mixing, rules, sharding

from .conftest import plain


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def covered_chars(words, n):
    """Characters of the words in runs of n that have stood earlier."""
    seen, hit = set(), set()
    for i in range(len(words) - n + 1):
        run = tuple(words[i : i + n])
        if run in seen:
            hit |= set(range(i, i + n))
        seen.add(run)
    return sum(len(words[i]) for i in hit)


def brute_rules(text):
    words = words_of(text)
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeat = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, lines, line_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if words_of(line):
            if line in seen:
                lines += 1
                line_chars += sum(map(len, words_of(line)))
            seen.add(line)
    chars = sum(map(len, words))
    dups = [covered_chars(words, n) for n in rules.NGRAM_LIMITS]
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    repetitive = 100 * line_chars > rules.LINE_LIMIT * chars or any(
        100 * d > limit * chars for d, limit in zip(dups, rules.NGRAM_LIMITS.values())
    )
    repetitive = repetitive and len(repeat) > rules.ALLOWED_WORDS
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), chars, symbols, lines, len(repeat), line_chars, *dups, failed, not failed and not repetitive)


def test_rules_of_odd_and_given_documents(odd, odd_rows, sample):
    expected = sorted(((r[0], *brute_rules(r[1])) for r in odd_rows), key=repr)
    assert plain(rules.apply_rules(odd, keep=("doc_id",))) == expected
    got = {r[0]: tuple(r)[1:] for r in rules.apply_rules(sample, keep=("doc_id",)).collect()}
    assert got == {r.doc_id: brute_rules(r.text) for r in sample.collect()}


def test_rules_carry_columns_and_replace_clashing_ones(spark, nothing):
    docs = spark.createDataFrame([("x", 5, {"a": 1})], "text string, n_words int, extra map<string,int>")
    out = rules.apply_rules(docs)
    assert out.columns[:2] == ["text", "extra"] and out.first().n_words == 1
    assert rules.apply_rules(nothing).collect() == []


def test_the_verdict_rejects_what_base_lets_through(spark):
    """Half of a long text stands twice; a short one only has a line at both ends."""
    passage = " ".join(f"passage{i}" for i in range(1200))
    long = " ".join([passage, *[f"other{i}" for i in range(7600)], passage])
    line = "This page may be read and shared by all who find some use in it."
    short = "\n".join([line, " ".join(f"word{i}" for i in range(50)), line])
    many = "\n".join([line, " ".join(f"word{i}" for i in range(100)), line, "an end", line, line, line])
    rows = [(1, long, "a"), (2, short, "b"), (3, many, "c"), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in rules.apply_rules(docs, keep=("doc_id",)).collect()}
    assert got == {1: (False, False), 2: (False, True), 3: (False, False), 4: (True, False)}
    assert {i: brute_rules(t)[-2:] for i, t, _ in rows} == got
    left = rules.keep_documents(docs)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [rows[1]]


def expected_targets(sizes, weights, most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        target |= {s: most * sizes[s] for s in over} if over else share
        open_ = open_ - over if over else set()
    return target


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (100, 1)])
def test_mix_meets_targets(spark, weights):
    rows = [(i, "w " * (1 + i * 7919 % 50), ["a", "b", "c", None, "dd"][min(i % 11, 4)]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.size_documents(docs)
    got = mixing.mix(sized, weights).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    target = expected_targets(sizes, weights)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.repeats <= 3
        taken[r.source] += r.repeats * r.size
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 25
    again = mixing.mix(mixing.size_documents(docs.repartition(7)), weights)
    assert plain(again) == sorted(map(tuple, got), key=repr)


def test_mixes_of_growing_budgets_are_nested(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 3 == 0]) for i in range(500)]
    sized = mixing.size_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    last = {}
    for share in (0.1, 0.4, 0.9, 1.7):
        now = {r.doc_id: r.repeats for r in mixing.mix(sized, (3, 1), share).collect()}
        assert all(now[d] >= n for d, n in last.items())
        last = now


def test_mix_of_odd_documents(odd, nothing, spark):
    sized = mixing.size_documents(odd)
    out = {(r.doc_id, r.source): r for r in mixing.mix(sized, (5, 2, 1)).collect()}
    assert out[(6, "a")].size == 0 and out[(3, None)].source_size == 64
    assert mixing.mix(mixing.size_documents(nothing), (5, 2, 1)).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    for r in mixing.mix(mixing.size_documents(empty), (5, 2, 1)).collect():
        assert (r.size, r.source_size, r.target, r.repeats) == (0, 0, 0.0, 0)


def spread_of(n_shards, sizes):
    sums, taken = sharding.difference(np.array([[s] + [0] * (n_shards - 1) for s in sizes]))
    back = np.zeros(n_shards, np.int64)
    for size, places in zip(sizes, taken):
        assert sorted(places) == list(range(n_shards))
        back[places[0]] += size
    assert sorted(back) == sorted(sums)
    return max(back) - min(back)


def test_differencing():
    assert spread_of(2, [8, 7, 6, 5, 4]) == 2  # the known result of the method
    assert spread_of(3, [5]) == 5
    draw = np.random.RandomState(1)
    assert spread_of(8, draw.randint(1, 10**6, 500)) < 1000


def check_shards(got, rows, n_shards, cell_bytes):
    assert len(got) == len(rows)
    sums, slots, where = Counter(), defaultdict(list), defaultdict(set)
    text_of = {r[0]: r[1] for r in rows}
    for r in got:
        text = text_of[r.doc_id]
        assert r.size == len((text or "").encode()) + 1
        assert r.text_crc32 == zlib.crc32((text or "").encode())
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    assert max(sums.values()) - min(sums[s] for s in range(n_shards)) <= cell_bytes


def test_shards_are_even_over_several_levels(spark):
    rows = [(i, f"text {i % 900} " * (1 + (i % 900) ** 2 % 50)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cell in (7, 50, 8192):  # 4, 2 and 1 levels
        out = sharding.shard_by_bytes(docs, ("doc_id",), 8, cell=cell)
        check_shards(out.collect(), rows, 8, 600)


def test_shards_of_odd_documents(odd, odd_rows, nothing):
    rows = [r for r in odd_rows if r[0] is not None]
    out = sharding.shard_by_bytes(odd.where("doc_id is not null"), ("doc_id",), 2).collect()
    check_shards(out, rows, 2, 10**6)
    assert sharding.shard_by_bytes(odd, ("doc_id",)).count() == len(odd_rows)
    assert sharding.shard_by_bytes(nothing, ("doc_id",)).collect() == []


def test_slots_over_many_pieces(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("shard"))
    out = sharding.with_slots(rows, F.xxhash64("doc_id"), rows_per_piece=40)
    got = defaultdict(list)
    for r in out.collect():
        got[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in got.values())


def test_columns_named_like_results_give_way(spark, odd):
    named = odd.withColumnRenamed("lang", "shard").withColumnRenamed("n_chars", "size")
    out = sharding.shard_by_bytes(named, keep=("doc_id", "shard", "size", "source"), n_shards=2)
    assert out.columns == ["doc_id", "source", "size", "text_crc32", "shard", "slot"]
    same = sharding.shard_by_bytes(odd, keep=("doc_id", "source"), n_shards=2)
    assert plain(out) == plain(same)
    item = sharding.shard_by_bytes(odd.withColumnRenamed("lang", "item"), keep=("doc_id", "item"), n_shards=2)
    assert item.count() == odd.count()
    sized = mixing.size_documents(odd)
    clashing = sized.select("*", F.lit("x").alias("target"), F.lit("y").alias("takes"), F.lit("z").alias("s"))
    mixed = mixing.mix(clashing, (5, 2, 1))
    assert mixed.columns == [*sized.columns, "takes", "s", "source_size", "target", "repeats"]
    assert plain(mixed.drop("takes", "s")) == plain(mixing.mix(sized, (5, 2, 1)))
