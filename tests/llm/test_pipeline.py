"""The pipeline's stages keep the columns of documents and take effect."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import corpus_pipeline
from holdfast.llm import quality, simhash
from holdfast.llm.common import table


def test_stages_on_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes) == dict(docs.dtypes)
            assert out.count() <= docs.count()


def test_one_of_each_group(spark):
    docs = spark.createDataFrame([(3, "a b c d e", "x"), (1, "A b c d e", "y"), (1, "A b c d e", "y"), (8, "quite another text", "z"), (None, "a b c d e", "n"),
                                  (8, "a second text under this number", "z2"), (None, "alone without a number", "n2")], "doc_id long, text string, source string")
    kept = sorted((str(r.doc_id), r.source) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect())
    assert kept == [("1", "y"), ("8", "z"), ("8", "z2"), ("None", "n2")]


def test_groups_are_those_of_the_operator(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, sf).select("doc_id").collect()}
    assert kept == {r.component_id for r in simhash.near_duplicates(docs).collect()}


def test_quality_goes_by_the_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, sf).select("doc_id").collect()}
    assert kept == {r.doc_id for r in quality.op10_quality_classifier(spark, sf).where("predicted = 1").collect()} and 0 < len(kept) < docs.count()


def test_contaminated_rows_go_by_their_own_text(spark, sf_dir):
    item = table(spark, sf_dir, "benchmark").orderBy("item_id").first().text
    docs = spark.createDataFrame([(1, f"before {item} behind"), (1, "another text of that number"), (None, item), (None, "free"), (4, None), (5, "")], "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, docs, sf_dir).collect()}
    assert kept == {(1, "another text of that number"), (None, "free"), (4, None), (5, "")}


def test_other_columns_come_through_as_they_are(spark, sf_dir):
    odd = spark.createDataFrame([(1, "some words here", datetime(2024, 1, 2, 3, 4, 5, 678901), bytearray(b"\x00\xff"), Decimal("1.25"), [1, None], "d", 7.5)],
                                "doc_id long, text string, `a.b` timestamp, row binary, key decimal(9,4), fp array<int>, digest string, others double")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns and dict(out.dtypes) == dict(odd.dtypes), name
        if name != "quality":
            assert out.collect() == odd.collect(), name


def test_strings_are_cut_and_columns_follow(spark):
    long = "é" * 60
    docs = spark.createDataFrame([(1, long, 60, None), (2, f"start {long} end", 70, "s")], "doc_id long, text string, n_chars long, source string")
    rows = {r.doc_id: r for r in corpus_pipeline.cut_repeated_strings(spark, docs, "").collect()}
    assert rows[1].text == long and rows[2].text == "start  end" and rows[2].n_chars == 10 and rows[2].source == "s"


def test_whole_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
