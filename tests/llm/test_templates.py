from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tarnwork.llm.templates import LITERALS, ODD_SLOT, SHARE, UNITS, WINDOW, find_leaks

from .conftest import plain

QUESTION = "Mary Smith had 15 apples and sold 3 kg of them to Paul for 7 dollars yesterday"
OTHER = "John Brown had 12 apples and sold 9 kg of them to Anna for 4 dollars yesterday"


def tokens_of(text):
    cleaned = re.sub(r"[^\w\s]|_", "", text or "")  # ASCII punctuation and symbols of the cases
    plain_tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", cleaned) if t]
    marks = []
    for t in plain_tokens:
        if re.search(r"\d", t):
            marks.append("0")
        elif t[0].isupper():
            marks.append("1")
        elif t in UNITS and marks and marks[-1] == "0":
            marks.append("2")
        else:
            marks.append(t.lower())
    return plain_tokens, marks


def brute(docs, items, n=WINDOW):
    """All alignments of all pairs, compared token by token."""
    out = set()
    for item_id, item in set(items):
        old, old_marks = tokens_of(item)
        rich = [
            at for at in range(len(old) - n + 1)
            if sum(m not in ("0", "1", "2") for m in old_marks[at : at + n]) >= LITERALS
        ]
        for doc_id, text in docs:
            new, new_marks = tokens_of(text)
            where = {}
            for pos in range(len(new) - n + 1):
                where.setdefault(tuple(new_marks[pos : pos + n]), []).append(pos)
            runs = {}
            for at in rich:
                for pos in where.get(tuple(old_marks[at : at + n]), []):
                    runs.setdefault(pos - at, set()).add(at)
            good, found = set(), []
            for shift, ats in runs.items():
                places = sorted({a + k for a in ats for k in range(n)})
                slots = [(old[p], new[p + shift]) for p in places if old_marks[p] in ("0", "1", "2")]
                odd = len(set(slots)) - len({a for a, _ in slots})
                if ODD_SLOT * odd <= len(set(slots)):
                    good |= ats
                    found.append((len(slots), sum(a != b for a, b in slots)))
            if rich and good and len(good) >= SHARE * len(rich):
                out.add((doc_id, item_id, len(good), len(rich), max(f[0] for f in found), min(f[1] for f in found)))
    return sorted(out, key=repr)


DOCUMENTS = [
    (1, f"So: {QUESTION}, they say."), (2, OTHER), (3, "nothing at all here"), (4, None), (5, ""),
    (6, " ".join(map(str, range(30)))), (7, f"{QUESTION} and {QUESTION}"), (8, f"{OTHER}\n\n{QUESTION}"),
    (9, QUESTION.replace("apples", "pears")), (10, " ".join(QUESTION.split()[:9])), (11, QUESTION.lower()),
    (12, "Mary Smith had 15 apples and sold 3 kg " + "of them to Paul for 7 dollars yesterday"),
    (2, OTHER), (None, QUESTION), (13, QUESTION + " word" * 20_000),
]
ITEMS = [
    (100, QUESTION), (101, "too short"), (102, None), (103, ""), (100, QUESTION),
    (104, "the same 5 and the same 5 are the same number of the same kind said Ann"),
]


def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return plain(find_leaks(d, b).drop("doc_key"))


def test_against_all_alignments(spark):
    assert leaks(spark, DOCUMENTS, ITEMS) == brute(DOCUMENTS, ITEMS)


def test_slots_must_be_consistent(spark):
    fine = "the same 8 and the same 8 are the same number of the same kind said Eve"
    mixed = "the same 8 and the same 9 are the same number of the same kind said Eve"
    found = leaks(spark, [(1, fine), (2, mixed)], ITEMS)
    assert [(r[0], r[1]) for r in found] == [(1, 104)]
    assert found == brute([(1, fine), (2, mixed)], ITEMS)


@pytest.mark.parametrize("large", [False, True])
def test_planted_items_of_given_documents(spark, sample, large, monkeypatch):
    from tarnwork.llm import templates

    if large:  # the join without a broadcast
        monkeypatch.setattr(templates, "fits_broadcast", lambda table: False)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = {r.item_id: " ".join(r.text.split()) for r in items.collect()}
    docs = {r.doc_id: " ".join(r.text.split()) for r in sample.collect()}
    planted = {(d, i) for d, text in docs.items() for i, item in texts.items() if item in text}
    found = {(r.doc_id, r.item_id) for r in find_leaks(sample, items).collect()}
    assert planted and planted <= found
    for d, i in found - planted:  # what else is found shares at least a window of words
        words = texts[i].split()
        assert any(" ".join(words[k : k + 6]) in docs[d] for k in range(len(words) - 5))


def test_empty_tables_and_extra_columns(spark, odd, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_leaks(nothing, items).collect() == []
    assert find_leaks(odd, items.where(F.lit(False))).collect() == []
    named = spark.createDataFrame([(1, QUESTION, 5, 6)], "doc_id long, text string, item long, h long")
    assert find_leaks(named, items).count() == 1


@pytest.mark.parametrize("change", [str.upper, str.lower, str.title])
def test_copies_in_another_letter_case(spark, change):
    item = "Then Tom Gray Weighed Both Of Them again, 3 kg on the left of the straße and the Rest Behind It"
    docs = [(1, change(f"so they say {item} and more")), (2, change("quite another text of the same kind " * 3))]
    assert [r[:2] for r in leaks(spark, docs, [(5, item)])] == [(1, 5)]
    other = change(item.replace("3 kg", "8 kg"))
    assert [r[:2] + r[-2:] for r in leaks(spark, [(1, other)], [(5, item)])] == [(1, 5, 2, 1)]


DENSE = [
    (1, "What is 15 percent of 240 plus 30 percent of 50?"), (2, "Who Wrote The Novel War And Peace In 1869?"),
    (3, "Name two primes."), (4, "12 7 9 11 3 8 5 1 6"), (5, "Ann has 5 Pears and Bob has 3 Plums and Carl has 2 Figs"),
]


def test_items_dense_in_slots(spark):
    docs = [(i, f"some words before: {text} And some after.") for i, text in DENSE]
    assert [r[:2] for r in leaks(spark, docs, DENSE)] == [(i, i) for i, _ in DENSE]
    others = [
        (1, "so what is 25 percent of 80 plus 10 percent of 90 then"),
        (2, "THE 5 AND 6 OR 7 PERCENT OF 8 PLUS 9 PERCENT OF 10"), (3, "name ten primes"),
        (4, "13 7 9 11 3 8 6 1 6"), (5, "Tom has 7 Kiwis and Ned has 9 Limes and Sue has 1 Melons"),
        (6, "what is 25 percent of 80 plus 10 percent and 90"), (7, None), (8, "12"),
    ]
    assert [r[:2] + r[-2:] for r in leaks(spark, others, DENSE)] == [(1, 1, 6, 4), (5, 5, 9, 9)]


def test_a_long_run_of_a_long_item_is_a_leak(spark):
    """13 equal words of a 400-word item count, though they are few of its windows; 12 do not."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    item, around = " ".join(words), " ".join(f"x{chr(97 + i % 26)}" for i in range(60))
    docs = [(k, f"{around} {' '.join(words[100 : 100 + k])} {around}") for k in (12, 13, 40)]
    assert [r[:2] for r in leaks(spark, docs, [(1, item)])] == [(13, 1), (40, 1)]


def test_items_of_one_or_two_words_match_nothing(spark):
    docs = [(i, f"the text number {i} holds the word") for i in range(5)]
    assert leaks(spark, docs, [(1, "the"), (2, "the text"), (3, "!")]) == []


@pytest.mark.parametrize("large", [False, True])
def test_windows_are_read_from_documents_with_a_block_of_the_benchmark(spark, large, monkeypatch):
    """Only those documents are searched for windows, and nothing is found less."""
    from tarnwork.llm import templates

    if large:  # both joins without a broadcast
        monkeypatch.setattr(templates, "fits_broadcast", lambda table: False)
        monkeypatch.setattr(templates, "NEAR_ROWS", 0)
    draw = random.Random(5)
    words = ["the", "Tom", "of", "3", "kg", "ran", "left", "Über", "to", "1,5", "it"]
    made = [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(60)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(4, 30)))) for i in range(6)]
    docs = [(d, text) for d, text in enumerate(made)]
    for k, (_, item) in enumerate(items):  # whole items at all places modulo the block
        docs += [(100 + 10 * k + j, " ".join([*["foreign"] * j, item, made[k]])) for j in range(5)]
    docs += [(1000 + d, f"text number {d} shares nothing with any item, not even a few of its tokens") for d in range(50)]
    read, plain_windows = [], templates.doc_windows

    def watched(table, key, text, widths):
        read.append({r.doc_id for r in table.select("doc_id").collect()})
        return plain_windows(table, key, text, widths)

    monkeypatch.setattr(templates, "doc_windows", watched)
    long_items = [i for i in items if len(i[1].split()) >= WINDOW]
    found = leaks(spark, docs, long_items)
    assert found and all(max(ids) < 1000 for ids in read)
    monkeypatch.setattr(templates, "near_docs", lambda docs, *_: docs)
    assert found == leaks(spark, docs, long_items)
    mixed = leaks(spark, docs, items)
    monkeypatch.undo()
    assert mixed == leaks(spark, docs, items)
