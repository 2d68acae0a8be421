"""Discriminant scores against the textbook formula, and accuracy on documents kept out of the fit."""

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import quality as q
from feedloom.llm.common import fold_of


def test_log_densities_are_the_gaussians():
    random = np.random.default_rng(0)
    x = [random.normal(k, 1 + k, (200, 4)) for k in (0, 1)]
    model = q.discriminant([200, 200], [a.sum(0) for a in x], [a.T @ a for a in x], pooled=0.0, spherical=0.0)
    point = random.normal(0, 1, (5, 4))
    for k, a in enumerate(x):
        mean, cov = a.mean(0), np.cov(a.T)
        d = point - mean
        want = -0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]
        got = model.log_densities(point)[:, k]
        assert np.allclose(got - got[0], want - want[0], atol=1e-3)


def test_missing_class_and_no_labels():
    size = 3
    zeros = np.zeros((2, size)), np.zeros((2, size, size))
    assert np.allclose(q.discriminant([0, 0], *zeros).scores(np.ones((2, size))), 0.5)
    one = q.discriminant([0, 5], [[0] * 3, [5] * 3], [np.zeros((3, 3)), 5 * np.ones((3, 3))])
    assert (one.scores(np.ones((1, size))) > 0.5).all()


def test_statistics_of_odd_texts():
    for text in ("", " ", "\n\n", "!", "a" * 100_000, "wort " * 20_000, "ß́"):
        assert np.isfinite(q.document_statistics(text)).all() and len(q.document_statistics(text)) == len(q.FEATURES)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    fold = fold_of(F.col("doc_id"), 3)
    found = q.quality_scores(docs, labels, learn=fold != 1).join(labels, "doc_id").where(fold == 1).collect()
    assert len(found) > 80
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "x y", 3), (2, "", 3), (2, "", 3)], "doc_id long, text string, features int")
    labels = spark.createDataFrame([(1, 1, 9), (1, None, 9), (None, 0, 9), (2, 7, 9)], "doc_id long, quality int, label int")
    assert q.quality_scores(docs, labels).count() == 4
    assert q.quality_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
