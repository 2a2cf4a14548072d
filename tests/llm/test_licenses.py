"""Licence scans: base places by brute force, expressions by example."""

from __future__ import annotations

import re

import pytest

from holdfast.llm import licenses


def slow_base(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(p for p, _ in places), ",".join(sorted({x for _, x in places}))


TEXTS = ["Licensed under CC BY-NC 4.0.", "the MIT License, the MIT\nlicense", "mit licenses", "cc by cc by apache LICENSE v2", "GNU General  Public-License",
         "cc by", "élan cc by", "", None]


@pytest.mark.parametrize("text", TEXTS)
def test_base_places(text):
    words, places, labels = slow_base(text)
    got = licenses.scan(text)
    assert got[:5] == (words, len(places), min(places, default=None), max(places, default=None), labels)
    assert set(filter(None, labels.split(","))) <= set(got[5].split(",")) and 0 <= got[6] <= 1


@pytest.mark.parametrize(("data", "text", "labels", "asked"), [
    (b"mit or (gpl-2.0-only with classpath-exception-2.0 and apache-2.0) then prose", "mit or ( gpl-2.0-only with classpath-exception-2.0 and apache-2.0 )",
     {"mit", "gpl", "apache"}, 1.0),
    (b"gpl-3.0-or-later and mit and", "gpl-3.0-or-later and mit", {"gpl", "mit"}, 3.0),
    (b"mit or gpl-3.0 and isc", "mit or gpl-3.0 and isc", {"mit", "gpl", "isc"}, 1.0),
    (b"mit apache-2.0", "mit", {"mit"}, 1.0),
])
def test_expressions(data, text, labels, asked):
    assert licenses.parse_expression(data) == (text, frozenset(labels), asked)


@pytest.mark.parametrize("data", [b"", b"and mit", b"(mit or isc", b"unheard-of", b"with x", b")", b"()", b"(("])
def test_no_expression(data):
    assert licenses.parse_expression(data) is None


def test_tags_and_odd_texts(spark, odd_docs, no_docs):
    assert licenses.scan("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nrest")[7] == ["( mit or apache-2.0 )"]
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count()
    assert licenses.scan_licenses(no_docs).count() == 0


def test_query_matches_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in licenses.op3_license_scan(spark, sf_dir).collect():
        words, places, labels = slow_base(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (words, len(places), labels)


@pytest.mark.parametrize(("data", "text", "labels", "asked"), [
    (b"mit and licenseref-closed", "mit and licenseref-closed", {"mit", "other"}, 3.0),
    (b"licenseref-closed or mit", "licenseref-closed or mit", {"mit", "other"}, 1.0),
    (b"gpl-3.0 or zlib", "gpl-3.0 or zlib", {"gpl", "zlib"}, 1.0),
    (b"mit and foo-1.0 or gpl-2.0", "mit and foo-1.0 or gpl-2.0", {"mit", "other", "gpl"}, 3.0),
    (b"licenseref-own", "licenseref-own", {"other"}, 3.0),
    (b"mit.", "mit", {"mit"}, 1.0),
    (b"(mit or apache-2.0). more", "( mit or apache-2.0 )", {"mit", "apache"}, 1.0),
    (b"mit and the rest", "mit", {"mit"}, 1.0),
])
def test_unlisted_identifiers_and_closing_dots(data, text, labels, asked):
    assert licenses.parse_expression(b"tag: " + data, 5) == (text, frozenset(labels), asked)


def test_many_phrases_and_tags_take_linear_time():
    import time

    began = time.time()
    many = licenses.scan("mit license " * 80_000)
    assert many[:4] == (160_000, 80_000, 0, 159_998)
    tags = licenses.scan("SPDX-License-Identifier: MIT OR Foo-2 " * 80_000)
    assert len(tags[7]) == 80_000 and tags[8] == 1.0
    assert time.time() - began < 4
