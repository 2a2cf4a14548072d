"""Every operator on documents takes texts of megabytes, with and without spaces, and gives each its row."""

from __future__ import annotations

import random

import pytest

from holdfast.llm import decontaminate, language, lexical, licenses, mixing, packing, quality, sharding, simhash, spelling, substrings
from holdfast.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(5_000)]
    item = table(spark, SF, "benchmark").orderBy("item_id").first().text
    rows = [(1, " ".join(rng.choices(words, k=500_000)) + " " + item), (2, "x" * 1_000_000), (3, "é" * 300_000 + " MIT License"), (4, "short text beside them"),
            (5, "a\n" * 400_000), (6, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2).cache()


RUNS = {
    "op1": lambda docs, items: packing.pack(docs).groupBy("doc_id").count(),
    "op2": lambda docs, items: simhash.near_duplicates(docs),
    "op3": lambda docs, items: licenses.scan_licenses(docs),
    "op4": lambda docs, items: language.identify(docs, language.train(docs.selectExpr("doc_id", "text", "IF(doc_id % 2 = 0, 'p', 'q') AS lang"))),
    "op6": lambda docs, items: sharding.shuffle_into_shards(docs, 3),
    "op7": lambda docs, items: mixing.score_texts(docs, 7, 2),
    "op8": lambda docs, items: substrings.remove_repeats(docs, keep="digest"),
    "op10": lambda docs, items: quality.score_quality(docs, quality.train(docs, docs.selectExpr("doc_id", "doc_id % 2 AS quality"))),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_each_row_has_its_answer(long_docs, spark, name):
    rows = RUNS[name](long_docs, table(spark, SF, "benchmark")).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4, 5, 6]


def test_searches_and_words(long_docs, spark):
    items = table(spark, SF, "benchmark")
    first = items.orderBy("item_id").first().item_id
    assert (1, first) in {(r.doc_id, r.item_id) for r in decontaminate.contaminated(long_docs, items).collect()}
    assert lexical.rank_documents(long_docs, items).where(f"item_id = {first} AND doc_id = 1").count() == 1
    words = {r.word: r.n for r in spelling.word_counts(long_docs).where("n >= 2").collect()}
    assert len(words) > 500 and all(len(w) >= 7 for w in words)
