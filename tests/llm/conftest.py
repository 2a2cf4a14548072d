from __future__ import annotations

import pytest

ODD_TEXTS = [None, "", " \n\t ", "a", "Word", "same text twice here now", "same text twice here now", "É ß 漢字 😀 no ascii",
             "x" * 30_000, "long words repeat " * 3_000, "Tab\tand\nline\x0bbreaks\x0c and NUL \x00 too", "<|endoftext|> is text here"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns whose names clash with results."""
    rows = [(i, t, None if i % 3 else "en", "s", 1, i % 2, "mine") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "no id at all", "en", None, None, 7, "mine"), (5, "another text under a used id", "de", "s", 3, 1, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, score string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
