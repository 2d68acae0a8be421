"""Quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import Staging

from .common import filter_texts, fold_columns, map_columns, texts

# Shares of the pooled covariance, and of a multiple of the identity, in each class covariance.
POOLED, SPHERICAL = 0.3, 0.05

FEATURES = (
    "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "stutter", "repeated_trigrams",
    "upper", "digits", "punctuation", "symbols", "lone_signs", "repeated_lines", "line_length", "sentence_ends", "same_first", "capital_words",
)

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_COMMON = re.compile(r"[.,;:'\"()-]")
_SYMBOL = re.compile(r"[!#$%&*+/<=>?@\[\\\]^_`{|}~]")


def _logit(share: float) -> float:
    return math.log((share + 0.002) / (1.002 - min(share, 1.0)))


def document_statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, log-odds of shares. Defined for an empty text."""
    words = text.split()
    n, chars = len(words), len(text)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    mean = lengths.mean() if n else 0.0
    trigrams = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [line for line in text.split("\n") if line]
    whole, per_word = max(chars, 1), max(n, 1)
    return [
        math.log1p(chars),
        math.log1p(n),
        math.log1p(mean),
        math.log1p(lengths.std() if n else 0.0),
        _logit(len(counts) / per_word) + 0.25 * math.log1p(n),
        _logit(max(counts.values(), default=0) / per_word),
        _logit(sum(map(str.__eq__, words, words[1:])) / per_word),
        _logit(1 - trigrams / (n - 2) if n > 2 else 0.0),
        _logit(len(_UPPER.findall(text)) / whole),
        _logit(len(_DIGIT.findall(text)) / whole),
        _logit(len(_COMMON.findall(text)) / whole),
        _logit(len(_SYMBOL.findall(text)) / whole),
        _logit(sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / per_word),
        _logit(1 - len(set(lines)) / len(lines) if lines else 0.0),
        math.log1p(chars / max(len(lines), 1)),
        _logit(sum(c for w, c in counts.items() if w[-1] in ".!?") / per_word),
        _logit(max(Counter(w[0] for w in counts).values(), default=0) / max(len(counts), 1)),
        _logit(sum(c for w, c in counts.items() if w[0].isupper()) / per_word),
    ]


def with_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and features, an array of doubles, for every row. No other column is read."""
    source = texts(docs, id_col, text_col)

    def make():
        return lambda ids, batch: (ids, [document_statistics(t) for t in batch])

    return map_columns(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, features array<double>", make)


@dataclass(frozen=True)
class Discriminant:
    """For each class: mean, inverse of the covariance's Cholesky factor, and log prior less half its log determinant."""

    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        z = np.einsum("kij,nkj->nki", self.inverses, x[:, None, :] - self.means)
        return self.offsets - 0.5 * (z * z).sum(axis=2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1. The log-odds are damped by the root of their number of features,
        as statistics of one text are far from independent; the sign stays."""
        d = self.log_densities(x)
        odds = (d[:, 1] - d[:, 0]) / math.sqrt(x.shape[1])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def discriminant(counts, sums, squares, *, pooled: float = POOLED, spherical: float = SPHERICAL) -> Discriminant:
    """From each class's number of rows, sum of x and sum of x x'. A class without rows gets the other's shape and a small prior."""
    counts, sums, squares = (np.asarray(a, float) for a in (counts, sums, squares))
    size, total = sums.shape[1], counts.sum()
    means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], sums.sum(0) / max(total, 1))
    scatter = squares - counts[:, None, None] * np.einsum("ki,kj->kij", means, means)
    common = scatter.sum(0) / max(total - 2, 1) + 1e-6 * np.eye(size)
    scale = np.sqrt(np.diag(common))
    inverses, offsets = [], []
    for k in range(2):
        own = scatter[k] / max(counts[k] - 1, 1) if counts[k] > 1 else common
        mixed = ((1 - pooled) * own + pooled * common) / np.outer(scale, scale)
        shrunk = (1 - spherical) * mixed + spherical * np.trace(mixed) / size * np.eye(size)
        factor = np.linalg.cholesky(shrunk + 1e-9 * np.eye(size))
        inverses.append(np.linalg.solve(factor, np.diag(1 / scale)))
        offsets.append(math.log((counts[k] + 1) / (total + 2)) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(inverses), np.array(offsets))


def fit_discriminant(labelled: DataFrame, **shrinkage) -> Discriminant:
    """Fitted on all rows of (features, label): each task adds up its classes, so only sums move."""
    size = len(FEATURES)

    def make():
        sums = np.zeros((2, 1 + size + size * size))

        def take(features, labels):
            x, y = np.array(features, float).reshape(-1, size), np.array(labels)
            for k in range(2):
                own = x[y == k]
                sums[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])

        return take, lambda: ([0, 1] * sums.shape[1], np.repeat(np.arange(sums.shape[1]), 2), sums.T.ravel())

    parts = fold_columns(labelled.select("features", "label"), "label int, place int, value double", make)
    found = parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect()
    sums = np.zeros((2, 1 + size + size * size))
    for row in found:
        sums[row.label, row.place] = row.value
    return discriminant(sums[:, 0], sums[:, 1 : 1 + size], sums[:, 1 + size :].reshape(2, size, size), **shrinkage)


def score_features(rows: DataFrame, model: Discriminant) -> DataFrame:
    def make():
        def work(ids, features):
            scores = model.scores(np.array(features, float).reshape(-1, len(FEATURES)))
            return ids, scores, (scores >= 0.5).astype(np.int32)

        return work

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int"
    return map_columns(rows.select("doc_id", "features"), schema, make)


def _fitted(rows: DataFrame, labels: DataFrame, learn: Column | None) -> Discriminant:
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    return fit_discriminant(rows.join(marked if learn is None else marked.where(learn), "doc_id"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted for every row of ``docs``, repeated rows as often as they occur.

    ``labels`` has doc_id and quality (0 or 1; other rows are passed over; a document labelled more
    than once counts with its mean, 0.5 and up as 1). ``learn``, a condition on ``doc_id``, chooses
    the documents to learn from. Statistics are worked out once, staged, and all the labelled ones
    learned from; texts do not move. Without any labels every score is 0.5.
    """
    staging = Staging(docs.sparkSession, "quality")
    rows = staging.write(with_statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    return score_features(rows, _fitted(rows, labels, learn))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the discriminant, learned from all labelled ones, takes for class 1; columns as they are.

    The model is applied where a text is read, so that only statistics move, and those of the
    learning pass are not kept. Without labels every row stays.
    """
    model = _fitted(with_statistics(docs, id_col=id_col, text_col=text_col), labels, None)

    def make():
        return lambda batch: model.scores(np.array([document_statistics(t) for t in batch], float).reshape(-1, len(FEATURES))) >= 0.5

    return filter_texts(docs, text_col, make)
