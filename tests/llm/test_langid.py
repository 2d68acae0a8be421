"""Codes, decoding and accuracy on documents kept out of the fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import langid
from feedloom.llm.common import fold_of


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = langid.code_matrix(n)
    assert len({tuple(row) for row in code}) == n
    assert (np.abs(code.sum(0)) < n).all()


def test_counts():
    assert langid.gram_counts("") is None and langid.gram_counts("12 ×÷ !?") is None
    assert langid.gram_counts("a").sum() == 3 + 2 + 1
    assert (langid.gram_counts("Ab c") == langid.gram_counts("ab 9 C")).all()
    assert langid.gram_counts("日本 x").sum() > 0


def test_decoding_corrects_a_wrong_bit():
    code = langid.code_matrix(4)
    weights = np.zeros((langid.SLOTS, 7))
    used = np.flatnonzero(langid.gram_counts("abc"))
    weights[used] = code[2] * 0.2
    weights[used, 3] *= -0.5
    model = langid.LanguageCode(list("wxyz"), code, weights, np.ones(7))
    assert model.predict("abc")[0] == "y" and not model.predict("abc")[2]
    level = langid.LanguageCode(list("wxyz"), code, np.zeros((langid.SLOTS, 7)), np.ones(7))
    assert level.predict("abc") == ("w", 0.25, True)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = fold_of(F.col("doc_id"), 5)
    found = langid.language_ids(docs, learn=fold != 0).join(docs.select("doc_id", "lang"), "doc_id").where(fold == 0).collect()
    assert len(found) > 150 and np.mean([r.lang_pred == r.lang for r in found]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_edges(spark):
    schema = "doc_id long, text string, lang string, slot int, n int"
    rows = [(1, "ein Haus", "de", 0, 0), (1, "ein Haus", "de", 0, 0), (None, "zwei", None, 0, 0), (3, None, "de", 0, 0), (4, "?!", "en", 0, 0)]
    found = langid.language_ids(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in found) == [(0, "de"), (1, "de"), (1, "de"), (3, "und"), (4, "und")]
    assert langid.language_ids(spark.createDataFrame([], schema)).count() == 0
    assert [r.lang_pred for r in langid.language_ids(spark.createDataFrame([(1, "x", None, 0, 0)], schema)).collect()] == ["und"]
