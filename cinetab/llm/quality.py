"""A quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class gets a Gaussian whose covariance is shrunk to the pooled one and to its own diagonal. The
score is the logistic of the classes' log-density difference; distances go through Cholesky factors
that are computed once, on the driver, from sums of a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import LOWERED, Words, keep_rows, materialize, ngram_hashes, passes

STATISTICS = (
    "log_words", "log_word_bytes", "upper", "symbols", "marks", "digits", "wide", "variety", "adjacent", "lines", "phrases", "top",
)


#: A short text says little: its statistics are drawn towards the ordinary ones, half way at so many words.
PRIOR_WORDS = 15


def _byte_classes() -> np.ndarray:
    """Which of lower, upper, symbol, mark, digit, wide each byte value is, one row a class."""
    table = np.zeros((6, 256))
    table[0, 97:123] = table[1, 65:91] = 1
    table[2, list(b"#*$%&|<>@^~\\{}[]_=+")] = 1
    table[3, list(b"!?;:")] = 1
    table[4, 48:58] = table[5, 128:] = 1
    return table


def statistics(words: Words) -> np.ndarray:
    """One row of transformed statistics for each text of a pass; a blank text has zeros."""
    n = len(words.first) - 1
    out = np.zeros((n, len(STATISTICS)))
    table, raw = _byte_classes(), words.data
    for i in range(n):
        a, b = words.first[i], words.first[i + 1]
        if a == b:
            continue
        part = raw[words.bounds[i] : words.bounds[i + 1]]
        kinds = table @ np.bincount(part, minlength=256)
        count = b - a
        letters = max(1.0, kinds[0] + kinds[1] + kinds[5])
        inked = float((words.ends[a:b] - words.begins[a:b]).sum())
        hashes = words.hashes[a:b]
        each = np.unique(hashes, return_counts=True)[1]
        lines = [x for x in part.tobytes().split(b"\n") if x.strip()]
        grams = ngram_hashes(hashes, 5)
        out[i] = (
            np.log1p(count), np.log(inked / count), np.sqrt(kinds[1] / letters), np.sqrt(kinds[2] / inked), np.sqrt(kinds[3] / inked),
            np.sqrt(kinds[4] / inked), np.sqrt(kinds[5] / inked), np.log(len(each)) / np.log(count) if count > 1 else 1.0,
            np.sqrt((hashes[1:] == hashes[:-1]).mean()) if count > 1 else 0.0, np.sqrt(1 - len(set(lines)) / max(1, len(lines))),
            np.sqrt(1 - len(np.unique(grams)) / len(grams)) if len(grams) else 0.0, np.sqrt((each.max() - 1) / count),
        )
    return out


def steadied(x: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Statistics weighed against the ordinary ones by the number of words; log_words stays as it is."""
    count = np.expm1(x[:, :1])
    return np.concatenate([x[:, :1], (count * x[:, 1:] + PRIOR_WORDS * ordinary[1:]) / (count + PRIOR_WORDS)], axis=1)


def describe(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>): the statistics of each whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in passes(batch.column(1)):
                x = statistics(Words(data, bounds, LOWERED))
                sizes = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.ListArray.from_arrays(sizes, pa.array(x.ravel()))], ["doc_id", "x"]
                )

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy()).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Discriminant:
    """Ordinary statistics, means, whitening matrices (inverse Cholesky factors), log determinants and log prior odds of label 1."""

    ordinary: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, from statistics as they are."""
        x = steadied(x, self.ordinary)
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            density.append(-0.5 * ((z * z).sum(axis=1) + self.log_det[k]))
        # Beyond the range of a double's exponential the score is 0 or 1 anyway.
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -700, 700)))


def _sums(labelled: DataFrame, parts: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Of each label, ``parts`` (a row of ``size`` numbers for a block of rows) summed up: each task sums its rows, Spark adds those up."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size))
        for batch in batches:
            x, label = _matrix(batch.column(0)), batch.column(1).to_numpy()
            for k in (0, 1):
                total[k] += parts(x[label == k])
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, k)), pa.array(np.arange(size)), pa.array(total[k])], ["label", "place", "value"])

    added = labelled.select("x", "label").mapInArrow(sums, "label long, place long, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    total = np.zeros((2, size))
    for label, place, value in added.collect():  # 2 * size numbers
        total[label, place] = value
    return total


def fit(labelled: DataFrame, to_pooled: float = 0.2, to_diagonal: float = 0.1) -> Discriminant:
    """Fit on all rows of (x, label), from sums of a fixed size.

    What is ordinary are the statistics of all words of texts with label 1 (or 0, if there are none). ``to_pooled`` shrinks
    a class covariance to the pooled one, ``to_diagonal`` the result to its diagonal. A class without rows takes
    the other's place with no weight of its own.
    """
    d = len(STATISTICS)
    words = _sums(labelled, lambda x: np.concatenate([[np.expm1(x[:, 0]).sum()], np.expm1(x[:, 0]) @ x]), 1 + d)
    home = words[1] if words[1, 0] else words[0]
    ordinary = home[1:] / max(home[0], 1.0)

    def moments(x: np.ndarray) -> np.ndarray:
        x = steadied(x, ordinary)
        return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])

    total = _sums(labelled, moments, 1 + d + d * d)
    count = total[:, 0]
    if not count.sum():
        return Discriminant(ordinary, np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), 0.0)
    means = total[:, 1 : d + 1] / np.maximum(count, 1)[:, None]
    spread = [total[k, d + 1 :].reshape(d, d) - count[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (spread[0] + spread[1]) / count.sum()
    floor = 1e-4 * np.eye(d)
    whiten, log_det = [], []
    for k in (0, 1):
        own = (1 - to_pooled) * spread[k] / max(count[k], 1) + to_pooled * pooled
        own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own)) + floor
        factor = np.linalg.cholesky(own)
        whiten.append(np.linalg.solve(factor, np.eye(d)))
        log_det.append(2 * np.log(np.diag(factor)).sum())
    if not count.all():
        means[count == 0] = means[count > 0]
    return Discriminant(ordinary, means, np.stack(whiten), np.array(log_det), float(np.log((count[1] + 1) / (count[0] + 1))))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def classify(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; learns from labelled rows that are not held out.

    Scores depend on the text alone. Null or blank texts have the ordinary statistics, of no words, and are scored like others.
    An id with several labels counts with each label once; null or other labels are ignored. Without any
    label every score is 0.5. Null and repeated ids stay row by row. Empty table: empty result.
    Rows of equal texts have equal scores, and a score of ``threshold`` is predicted as 1. A text is described whole in
    passes over its bytes, however long; it is held once. Other columns are not read.
    """
    described = materialize(describe(documents, id_col, text_col).withColumn("held_out", held_out("doc_id")), "statistics")
    model = _fitted(described, labels, id_col, label_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(model.score(_matrix(batch.column(2))))], ["doc_id", "held_out", "score"])

    scored = described.select("doc_id", "held_out", "x").mapInArrow(work, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def _fitted(described: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> Discriminant:
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("label")).where("label in (0, 1)").distinct()
    return fit(described.where("not held_out").join(marks, "doc_id"))


def keep_good(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3
) -> DataFrame:
    """The rows of ``documents`` that ``classify`` predicts as 1, with all columns.

    Only the narrow statistics are written and shuffled; texts are read twice instead.
    """
    described = materialize(describe(documents, id_col, text_col).withColumn("held_out", held_out("doc_id")), "statistics")
    model = _fitted(described, labels, id_col, label_col)
    return keep_rows(documents, text_col, LOWERED, lambda words: model.score(statistics(words)) >= threshold)
