from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnwork.llm import classifier, licenses, pii, queries

from .conftest import plain

KEY = b"a test key"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 777, 1000])
def test_permutation_is_one_to_one(size):
    out = [pii.permute(i, size, KEY, "k") for i in range(size)]
    assert sorted(out) == list(range(size))
    assert [pii.permute(x, size, KEY, "k", back=True) for x in out] == list(range(size))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="0123456789-./+() @abZ\n", max_size=60), st.binary(min_size=1, max_size=16))
def test_pseudonyms_can_be_undone(text, key):
    new, spans = pii.pseudonymize_text(text, key)
    back, again = pii.pseudonymize_text(new, key, back=True)
    if [k for k, *_ in spans] == [k for k, *_ in again]:
        assert back == text
    for _, a, b in spans:
        assert 0 <= a < b <= len(new)


def cards(text):
    return [m for m in re.findall(r"\d{16}", text) if pii.luhn_digit(m[:-1]) == int(m[-1])]


def test_formats_and_validity():
    text = (
        "card 4845168114407329, 4845-1681-1440-7329; not 9807915762804490; on 2000-02-29 and 29.02.2000, "
        "not 2001-02-29; DE89 3704 0044 0532 0130 00; 97.51.17.173 not 999.1.1.1; +1 (017) 555-7713; a.b+c9@mail.example.com"
    )
    new, spans = pii.pseudonymize_text(text, KEY)
    kinds = [k for k, *_ in spans]
    assert kinds == ["card", "card", "date", "day", "iban", "ip", "phone", "mail"]
    values = [new[a:b] for _, a, b in spans]
    assert re.fullmatch(r"(\d{4}-){3}\d{4}", values[1]) and values[1].replace("-", "") == values[0]
    assert cards(values[0]) and values[0] not in text
    year, month, day = values[2].split("-")
    assert values[3] == f"{day}.{month}.{year}"
    plain_iban = values[4].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in plain_iban[4:] + plain_iban[:4])) % 97 == 1
    assert all(0 <= int(x) < 256 for x in values[5].split("."))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", values[6])
    assert re.fullmatch(r"[a-z]\.[a-z]\+[a-z]\d@mail\.example\.com", values[7])
    for kept in ("9807915762804490", "2001-02-29", "999.1.1.1"):
        assert kept in new
    assert pii.pseudonymize_text(new, KEY, back=True)[0] == text
    assert pii.pseudonymize_text(text, b"another")[0] != new


def test_pseudonyms_of_documents(spark, odd, nothing, sample):
    out = pii.pseudonymize(odd.withColumnRenamed("lang", "pseudonyms"), KEY)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "pseudonyms"]
    assert plain(out.select("doc_id", "text")) == plain(odd.select("doc_id", "text"))  # nothing to find
    assert pii.pseudonymize(nothing, KEY).collect() == []
    hidden = pii.pseudonymize(sample.select("doc_id", "text"), KEY)
    texts, found = {r.doc_id: r.text for r in sample.collect()}, 0
    for r in hidden.collect():
        expected, spans = pii.pseudonymize_text(texts[r.doc_id], KEY)
        assert r.text == expected and [tuple(s) for s in r.pseudonyms] == spans
        for value in cards(texts[r.doc_id]) + re.findall(r"\S+@[\w.]+|\+1 \(\d{3}\) \d{3}-\d{4}", texts[r.doc_id]):
            assert value not in r.text
        found += len(spans)
    assert found
    shown = pii.pseudonymize(hidden.drop("pseudonyms"), KEY, back=True)
    assert {r.doc_id: r.text for r in shown.collect()} == texts


@pytest.mark.parametrize(
    "kind, value, shape",
    [
        ("day", "12/31/2024", r"(0[1-9]|1[0-2])/(1[3-9]|2\d|3[01])/\d{4}"),
        ("personal", "123-45-6789", r"\d{3}-\d\d-\d{4}"),
        ("ip6", "fe80::1", r"[0-9a-f]{4}::[0-9a-f]"),
        ("ip6", "2001:0db8::00ff:10.", r"[0-9a-f]{4}:0[0-9a-f]{3}::00[0-9a-f]{2}:[0-9a-f]{2}"),
        ("iban", "de89 3704 0044 0532 0130 00", r"de\d\d( \d{4}){4} \d\d"),
        ("written", "March 5, 1990", r"[A-Z][a-z]+ [1-9], \d{4}"),
        ("written", "25 DECEMBER 2001", r"\d\d [A-Z]+ \d{4}"),
        ("written", "may 07 1999", r"[a-z]+ 0\d \d{4}"),
    ],
)
def test_further_formats(kind, value, shape):
    text = f"on {value} and so on"
    new, spans = pii.pseudonymize_text(text, KEY)
    assert [k for k, *_ in spans] == [kind]
    found = new[spans[0][1] : spans[0][2]]
    assert re.fullmatch(shape, found) and found != value
    assert pii.pseudonymize_text(new, KEY, back=True)[0] == text


def test_one_value_in_several_notations():
    def only(text):
        new, spans = pii.pseudonymize_text(text, KEY)
        (_, a, b), = spans
        return new[a:b]

    year, month, day = only("2024-12-31").split("-")
    assert only("12/31/2024") == f"{month}/{day}/{year}" and only("31.12.2024") == f"{day}.{month}.{year}"
    assert only("December 31, 2024") == f"{pii.MONTHS[int(month) - 1]} {day}, {year}"
    full = only("fe80:0000:0000:0000:0000:0000:0000:0001").split(":")
    assert only("fe80::1") == f"{full[0]}::{full[7][3]}" and full[1:7] == ["0000"] * 6
    iban = only("GB82 WEST 1234 5698 7654 32")
    assert only("gb82west12345698765432") == iban[:2].lower() + iban[2:].replace(" ", "").lower()


@pytest.mark.parametrize(
    "text",
    ["000-12-3456", "666-12-3456", "901-12-3456", "123-00-4567", "123-45-0000", "13/32/2024", "February 30, 2001",
     "abc::def", "12:30:45", "aa:bb:cc:dd:ee:01", "xx89 some words of a text", "std::vector<int>::at(0)"],
)
def test_values_that_are_not_in_use_stay(text):
    assert pii.pseudonymize_text(text, KEY) == (text, [])


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**128 - 1), st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31)), st.integers(0, 10**9 - 1))
def test_further_formats_can_be_undone(address, date, number):
    for text in (
        str(ipaddress.IPv6Address(address)), ipaddress.IPv6Address(address).exploded, f"{date:%m/%d/%Y}", f"{date:%d.%m.%Y}",
        f"{date:%B} {date.day}, {date.year}", f"{number:09d}"[:3] + f"-{number:09d}"[3:6] + f"-{number:09d}"[5:],
    ):
        new, spans = pii.pseudonymize_text(text, KEY)
        assert pii.pseudonymize_text(new, KEY, back=True)[0] == text
        assert len(spans) <= 1


def plain_permute(value, size, kind):
    """The permutation anew: all of it by hand, over digits in a list."""
    a = 1
    while a * a < size:
        a += 1
    b = (size + a - 1) // a
    while True:
        pair, bases = [value // b, value % b], [a, b]
        for k in range(10):
            side = k % 2
            message = ":".join([kind, str(k), str(pair[1 - side])])
            word = hashlib.blake2b(message.encode(), key=KEY).hexdigest()
            pair[side] = (pair[side] + int(word, 16) % bases[side]) % bases[side]
        value = pair[0] * b + pair[1]
        if value < size:
            return value


def test_pseudonyms_against_a_plain_computation(sample):
    days = [dt.date(1900, 1, 1) + dt.timedelta(n) for n in range(73049)]
    assert days[-1] == dt.date(2099, 12, 31)
    band = lambda d: 0 if d.day <= 9 else 1 if d.day <= 12 else 2

    def luhn_ok(digits):
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
        return sum(d // 10 + d % 10 for d in doubled) % 10 == 0

    def card(old):
        body = f"{plain_permute(int(old[:-1]), 10 ** (len(old) - 1), f'card{len(old) - 1}'):0{len(old) - 1}d}"
        return next(body + c for c in "0123456789" if luhn_ok(body + c))

    def ip(old):
        a, b, c, d = map(int, old.split("."))
        n = plain_permute(a * 2**24 + b * 2**16 + c * 2**8 + d, 2**32, "ip")
        return f"{n // 2**24}.{n // 2**16 % 256}.{n // 256 % 256}.{n % 256}"

    def date(old):
        here = days.index(dt.date.fromisoformat(old))
        there = plain_permute(here, len(days), "date")
        while band(days[there]) != band(days[here]):
            there = plain_permute(there, len(days), "date")
        return days[there].isoformat()

    def iban(old):
        body = f"{plain_permute(int(old[4:]), 10 ** len(old[4:]), 'iban' + '0' * len(old[4:])):0{len(old[4:])}d}"
        letters = "".join(str(ord(c) - 55) for c in old[:2])
        return next(old[:2] + f"{c:02d}" + body for c in range(2, 99) if int(body + letters + f"{c:02d}") % 97 == 1)

    checked = 0
    texts = [r.text for r in sample.collect() if r.text]
    texts += ["4845168114407329 and 97.51.17.173", "2000-02-29 or 1999-12-11", "DE89370400440532013000", "8.8.8.8 and 1.2.3.4"]
    for text in texts:
        new, spans = pii.pseudonymize_text(text, KEY)
        if len(new) != len(text):
            continue  # a written date; the places of the others have moved
        for kind, a, b in spans:
            old = text[a:b]
            if kind == "card" and old.isdigit():
                assert new[a:b] == card(old)
            elif kind == "ip":
                assert new[a:b] == ip(old)
            elif kind == "date" and "-" in old:
                assert new[a:b] == date(old)
            elif kind == "iban" and old[2:].isdigit():
                assert new[a:b] == iban(old)
            else:
                continue
            checked += 1
    assert checked >= 7


def test_texts_of_one_id_are_learned_alike_in_every_run(spark):
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(60)] + [(i, "another text of it") for i in range(0, 60, 3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    fits = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        fits.append(classifier.fit(docs, labels, learn=F.lit(True)))
    for part in ("feature", "threshold", "leaf"):
        assert np.array_equal(getattr(fits[0], part), getattr(fits[1], part))


def test_scores_replace_a_kept_column(spark, odd):
    trees = classifier.fit_trees(np.zeros((4, len(classifier.FEATURES)), np.float32), np.array([0, 1, 0, 1]))
    out = classifier.score(odd.withColumnRenamed("lang", "score"), trees, keep=("doc_id", "score"))
    assert out.columns == ["doc_id", "score"] and dict(out.dtypes)["score"] == "double"
    assert out.count() == odd.count()


def brute_cosines(files):
    """Best template of every passage of every file, terms counted one by one."""
    vocabulary = {t for _, x in licenses.TEMPLATES for t in licenses._split(x)}
    n = len(files)
    seen = {t: sum(t in licenses._split(x or "") for _, x in files) for t in vocabulary}
    idf = lambda t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1

    def vector(text):
        words = licenses._split(text)
        return {t: words.count(t) * idf(t) for t in words}

    def cosine(a, b):
        return sum(v * b.get(t, 0) for t, v in a.items()) / math.sqrt(
            sum(v * v for v in a.values()) * sum(v * v for v in b.values())
        )

    vectors = [(name, vector(x)) for name, x in licenses.TEMPLATES]
    out = {}
    for path, text in files:
        passages = (text or "").split("\n")
        passages += [x for line in passages for x in re.split(r"(?<=[.;!?])\s+", line)]
        block = []
        for line in [*(text or "").split("\n"), ""]:
            if re.search(r"[^\W_]", line):
                block.append(line)
            else:
                passages.append("\n".join(block))
                block = []
        if path and re.search(licenses._LICENCE_FILE, path):
            passages.append(text or "")
        last = lambda name: (name == "BSD-2-Clause") + 2 * (name == "Proprietary")
        best = [
            (last(name), -round(cosine(v, t), 6), name) for p in passages if (v := vector(p)) for name, t in vectors
            if round(cosine(v, t), 6) >= licenses.THRESHOLD
        ]
        if best:
            out[path] = (min(best)[2], -min(best)[1])
    return out


FILES = [
    ("LICENSE", "Released under the MIT License."), ("a/LICENSE.txt", "text\n\nAll rights\nreserved."),
    ("a/x.py", "some code"), ("a/b/y.py", "code\nLicensed under the Apache License, Version 2.0.\nmore"),
    ("a/b/z.py", "code only"), ("c/d/e/f.py", ""), ("c/d/g.py", None), ("c/COPYING", "no licence in here"),
    ("d/LICENSE", "Released under the MIT License."), ("d/NOTICE", "This work is licensed under the GNU General Public License, version 2"),
    ("d/w.py", "the license"), (None, "All rights reserved."), ("a/x.py", "some code"),
    ("e/one.py", "# Copyright 2020 Somebody. All rights reserved. Released under the MIT License. See there for the rest of it."),
    ("e/two.py", "#\n# Redistribution and use in source and binary forms, with or\n# without modification, are permitted provided that\n# the following conditions are met\n#\nx = 1"),
    ("d/long.txt", "words " * 20_000 + "\nLicensed under CC BY-NC 4.0."), ("top.py", "rights and wrongs"),
]


def test_licenses_against_all_cosines(spark):
    files = spark.createDataFrame(FILES, "path string, text string")
    own = {r.path: (r.license, r.cosine) for r in licenses.own_licenses(files).collect()}
    expected = brute_cosines(FILES)
    assert own.keys() == expected.keys()
    for path, (name, cosine) in expected.items():
        assert own[path][0] == name and own[path][1] == pytest.approx(cosine, abs=2e-6)


def test_licenses_are_inherited_from_the_nearest_directory(spark, nothing):
    files = spark.createDataFrame([(*f, i) for i, f in enumerate(FILES)], "path string, text string, license int")
    out = licenses.scan_licenses(files.drop("license"))
    got = {r.path: (r.license, r.inherited_from) for r in out.collect()}
    assert out.count() == len(FILES)
    assert got["a/x.py"] == ("Proprietary", "a") and got["a/b/z.py"] == ("Proprietary", "a")
    assert got["a/b/y.py"] == ("Apache-2.0", None) and got["d/long.txt"] == ("CC-BY-NC-4.0", None)
    assert got["c/d/e/f.py"] == ("MIT", "") and got["c/COPYING"] == ("MIT", "") and got["top.py"] == ("MIT", "")
    assert got["d/w.py"] == ("GPL-2.0-only", "d") and got[None] == ("Proprietary", None)
    clash = licenses.scan_licenses(files, keep=("license",))  # a column of the same name is carried
    assert clash.columns.count("license") == 2 and clash.count() == len(FILES)
    assert licenses.scan_licenses(nothing.selectExpr("lang as path", "text")).collect() == []


HEADS = {
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "GPL-3.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.",
    "GPL-2.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.",
    "AGPL-3.0-only": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.",
    "LGPL-3.0-only": "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.",
    "MIT": "Copyright (c) 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction",
    "ISC": "Copyright (c) 2020, Somebody\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Copyright (c) 2020, Somebody\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause": "Copyright (c) 2020, Somebody\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.",
    "MPL-2.0": "Mozilla Public License Version 2.0\n==================================",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy",
    "Proprietary": "Copyright 2020 Somebody. All rights reserved.",
}


def test_heads_of_licence_files(spark):
    files = [(f"{name}/LICENSE", text) for name, text in HEADS.items()]
    files += [(f"{name}/code.py", "x = 1") for name in HEADS] + [(f"w{i}.txt", "plain words of a text") for i in range(40)]
    df = spark.createDataFrame(files, "path string, text string")
    out = {r["path"]: r["license"] for r in licenses.scan_licenses(df).collect()}
    assert {p: x for p, x in out.items() if p.endswith("LICENSE")} == {f"{name}/LICENSE": name for name in HEADS}
    assert {p: x for p, x in out.items() if p.endswith(".py")} == {f"{name}/code.py": name for name in HEADS}
    assert {x for p, x in out.items() if p.startswith("w")} == {None}


def test_files_without_a_path_keep_their_own_licences(spark):
    texts = ["Released under the MIT License.", "prose", "All rights reserved.", None]
    df = spark.createDataFrame([(None, t) for t in texts], "path string, text string")
    out = sorted((r["license"] or "" for r in licenses.scan_licenses(df).collect()))
    assert out == ["", "", "MIT", "Proprietary"]


def test_trees_learn_and_walk_like_a_loop():
    draw = np.random.RandomState(0)
    rows = draw.rand(2000, 6).astype(np.float32)
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 3] > 0.3)).astype(int)
    trees = classifier.fit_trees(rows[:1500], labels[:1500], n_trees=30)
    scores = trees.score(rows[1500:])
    assert ((scores > 0.5) == labels[1500:]).mean() > 0.97
    for row, got in zip(rows[1500:1520], scores):
        total = trees.base
        for t in range(len(trees.leaf)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - trees.feature.shape[1]]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_trees_without_rows_or_with_one_label():
    none = classifier.fit_trees(np.zeros((0, 3), np.float32), np.zeros(0))
    assert none.score(np.zeros((2, 3), np.float32)).tolist() == [0.5, 0.5]
    ones = classifier.fit_trees(np.random.rand(50, 3).astype(np.float32), np.ones(50))
    assert ones.score(np.zeros((1, 3), np.float32))[0] > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_boosted_quality(spark, folder).collect()}
    assert len(got) == 1000
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(got[r.doc_id].held_out for r in held)
    right = sum(got[r.doc_id].predicted == r.quality for r in held)
    assert right / len(held) > 0.95


def test_scores_of_odd_documents(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (7, None), (None, 1), (17, 1)], "doc_id long, quality int")
    trees = classifier.fit(odd, labels, labels.doc_id != 4)
    out = classifier.score(odd, trees, ("doc_id", "source")).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert classifier.score(nothing, trees, ("doc_id",)).collect() == []
    classifier.fit(nothing, labels.limit(0), labels.doc_id != 4)


IBAN, PHONE = "DE89 3704 0044 0532 0130 00", "+1 (017) 555-7713"


@pytest.mark.parametrize(
    "value, text",
    [
        (IBAN, "IBAN {} BIC COBADEFFXXX"), (IBAN, "{} EUR 500"), (IBAN, "AB12 {}"), (PHONE, "call {} 2024"),
        (PHONE, "{} 12 34"), ("+44 20 7946 0958", "{} 2024"), ("4845168114407329", "+1 22 {}"),
        ("4845-1681-1440-7329", "no. 1234 {}"), ("97.51.17.173", "99-99-2000 {}"), ("+49 30 12 34 56 78", "{}"),
    ],
)
def test_values_beside_other_words(value, text):
    alone, _ = pii.pseudonymize_text(value, KEY)
    assert alone != value
    new, spans = pii.pseudonymize_text(text.format(value), KEY)
    assert new == text.format(alone) and len(spans) == 1
    assert pii.pseudonymize_text(new, KEY, back=True)[0] == text.format(value)


def test_files_without_a_path_do_not_license_each_other(spark):
    rows = [(None, "Released under the MIT License."), (None, "plain prose of no licence"), (None, "All rights reserved."),
            ("a/x", "Released under the MIT License."), ("a/x", "other words")]
    files = spark.createDataFrame(rows, "path string, text string")
    got = licenses.scan_licenses(files, keep=("text",)).collect()
    assert {(r.path, r.text): r.license for r in got} == {
        (None, rows[0][1]): "MIT", (None, rows[1][1]): None, (None, rows[2][1]): "Proprietary",
        ("a/x", rows[3][1]): "MIT", ("a/x", rows[4][1]): None,
    }
