"""Trained operators: accuracy on rows they never saw, and odd input."""

from __future__ import annotations

from holdfast.llm import common, language, quality

SF = "/root/testdata/sf0.01"


def test_language(spark, odd_docs, no_docs):
    rows = language.op4_language_id(spark, SF).join(common.table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    model = language.train(odd_docs)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd_docs, model).collect()}
    assert {(0, "und"), (1, "und"), (2, "und")} <= got and (3, "und") not in got
    assert language.train(no_docs) is None and language.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in language.identify(odd_docs, None).collect()} == {"und"}


def test_quality(spark, odd_docs, no_docs):
    labels = common.table(spark, SF, "labels")
    rows = quality.op10_quality_classifier(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    model = quality.train(common.table(spark, SF, "documents"), labels.where("false"))
    scores = quality.score_quality(odd_docs, model).collect()
    assert len(scores) == odd_docs.count() and {round(r.score, 6) for r in scores} == {0.5}
    assert quality.score_quality(no_docs, model).count() == 0


def test_language_model_is_bounded_and_texts_stay(spark, monkeypatch):
    """However many values lang has, the fit sees a bounded number of rows, and no exchange carries text."""
    docs = spark.range(3_000).selectExpr("id AS doc_id", "CONCAT('lang', id % 300) AS lang", "CONCAT('word', id, ' and more words of it') AS text")
    seen = []
    monkeypatch.setattr(language, "fit_in_task", lambda features, fit: seen.append(features))
    language.train(docs, most_rows=200)
    assert 100 <= seen[0].count() <= 320
    language.train(common.table(spark, SF, "documents"))
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(seen[1]._jdf.queryExecution(), "formatted")
    exchanges = [block for block in plan.split("\n\n") if "Exchange" in block.split("\n")[0]]
    assert "BroadcastHashJoin" in plan and not any("text#" in block for block in exchanges)


def test_language_scores_by_brute_force(spark):
    """The answer is the softmax of the mean of the table's rows over all subwords of the whole text."""
    import numpy as np

    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    model = language.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for r in docs.collect():
        words = language.utf8(r.text.lower()).translate(language._LETTERS).split()
        buckets, counts = language.counted(r.text)
        if not words:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        x = (counts @ model["table"][buckets].astype(np.float64) / counts.sum() + model["bias"]) / model["heat"]
        p = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        assert got[r.doc_id][0] == model["names"][int(p.argmax())] and abs(got[r.doc_id][1] - p.max()) < 1e-4


def test_quality_scores_by_brute_force(spark):
    """One text after the other gives what the query gives for all."""
    rows = {r.doc_id: r.score for r in quality.op10_quality_classifier(spark, "/root/testdata/sf0.001").collect()}
    texts = common.table(spark, "/root/testdata/sf0.001", "documents").collect()
    model = quality.trained_on_folds(spark, "/root/testdata/sf0.001")
    assert len(rows) == len(texts)
    for r in texts[:60]:
        alone = quality.score_quality(spark.createDataFrame([(r.doc_id, r.text)], "doc_id long, text string"), model).first() if r.doc_id % 20 == 0 else None
        assert alone is None or abs(alone.score - rows[r.doc_id]) < 1e-9
