"""Operator 6: regularised quadratic discriminant over transformed document statistics.

Statistics of a whole text (length, shares of letters in upper case, digits, punctuation and symbols, repeated and distinct
words, ...) are made Gaussian-like by logarithms and square roots.  Spark sums counts, first and second moments per class
over all labelled rows outside the held-out fold, so the fit does not depend on a sample and what the driver gets is one row
per class.  A class covariance is shrunk towards the pooled one and its diagonal; its inverse Cholesky factor and log
determinant are computed once and go to the workers with the task.  A score is the logistic of the difference of the two
log densities, each half a squared Mahalanobis distance and the log determinant.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import bytetext
from tallyhouse.llm.folds import in_fold
from tallyhouse.sources.workdir import settle

FOLDS = 5
THRESHOLD = 0.3
#: Weight of the pooled covariance in a class's own, and of the diagonal in the result; the least variance of a statistic.
TO_POOLED, TO_DIAGONAL, LEAST_VARIANCE = 0.1, 0.05, 1e-4
#: Largest absolute log-density difference that still changes a score.
STEEPEST = 40.0

STATISTICS = (
    "log_bytes", "log_word_bytes", "upper", "digit", "sentence_mark", "loud_mark", "symbol", "space",
    "repeated_word", "distinct_word", "letterless_word", "log_line_words",
)


def _class(members: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members.encode())] = True
    return table


_LETTER = _class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)
_BYTE_CLASSES = {
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _class("0123456789"),
    "sentence_mark": _class(".,;:?'\"()-"),
    "loud_mark": _class("!"),
    "symbol": _class("#$%&*+/<=>@[\\]^_`{|}~"),
    "space": bytetext.SPACES,
}


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def statistics(run: bytetext.Run) -> np.ndarray:
    """One row of transformed statistics per text of a run; an empty text has zeros."""
    w = bytetext.words(run)
    n_bytes, n_words = np.diff(run.offsets), np.diff(w.first)
    per_byte, per_word = 1 / np.maximum(n_bytes, 1), 1 / np.maximum(n_words, 1)
    out = dict.fromkeys(STATISTICS)
    out["log_bytes"] = np.log1p(n_bytes)
    out["log_word_bytes"] = np.log1p(n_bytes * per_word * (n_words > 0))
    for name, table in _BYTE_CLASSES.items():
        out[name] = np.sqrt(_sums(table[run.data], run.offsets) * per_byte)
    owner = w.text_of()
    again = np.zeros(len(owner), bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    out["repeated_word"] = np.sqrt(_sums(again, w.first) * per_word)
    order = np.lexsort((w.hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w.hashes[order][1:] != w.hashes[order][:-1]) | (owner[1:] != owner[:-1])
    distinct = _sums(fresh, w.first)
    # distinct words grow more slowly than words; a power takes the length out
    out["distinct_word"] = distinct * np.maximum(n_words, 1) ** -0.9
    letters = np.concatenate([[0], np.cumsum(_LETTER[run.data])])
    out["letterless_word"] = np.sqrt(_sums(letters[w.ends] == letters[w.starts], w.first) * per_word)
    out["log_line_words"] = np.log1p(n_words / (1 + _sums(run.data == 10, run.offsets)))
    return np.stack([np.asarray(out[s], float) for s in STATISTICS], axis=1)


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text; a null text counts as empty."""
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in bytetext.runs(batch.column(1)):
                values = statistics(r)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[r.first : r.last], lists], names=[doc_id, "x"])

    return docs.select(doc_id, text).mapInArrow(run, schema)


class ClassDensity(NamedTuple):
    mean: np.ndarray
    inverse_factor: np.ndarray
    log_weight: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse_factor.T
        return self.log_weight - 0.5 * np.einsum("ij,ij->i", z, z)


def moments(rows: DataFrame, label: str = "label", x: str = "x") -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class the number of rows, the mean and the covariance, from sums that Spark makes."""
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(F.col(x)[i]).alias(f"s{i}") for i in range(d)]
    sums += [F.sum(F.col(x)[i] * F.col(x)[j]).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r.n
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r.n
        out[int(r[label])] = (r.n, mean, second - np.outer(mean, mean))
    return out


def fit(by_class: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> dict[int, ClassDensity]:
    """Densities with shrunk covariances; none without rows."""
    if not by_class:
        return {}
    total = sum(n for n, _, _ in by_class.values())
    pooled = sum(n * c for n, _, c in by_class.values()) / total
    out = {}
    for label, (n, mean, own) in by_class.items():
        cov = (1 - TO_POOLED) * own + TO_POOLED * pooled
        cov = (1 - TO_DIAGONAL) * cov + np.diag(TO_DIAGONAL * np.diag(cov) + LEAST_VARIANCE)
        factor = np.linalg.cholesky(cov)
        weight = np.log(n / total) - np.log(np.diag(factor)).sum()
        out[label] = ClassDensity(mean, np.linalg.inv(factor), weight)
    return out


def score(densities: dict[int, ClassDensity], x: np.ndarray) -> np.ndarray:
    """Probability of label 1; one label alone, or none, leaves 1, 0 or a half."""
    if set(densities) != {0, 1}:
        return np.full(len(x), float(next(iter(densities), 0.5)))
    gap = np.clip(densities[1].log_density(x) - densities[0].log_density(x), -STEEPEST, STEEPEST)
    return 1 / (1 + np.exp(-gap))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Labels other than 0 and 1 and null ids teach nothing; a document labelled twice counts twice.  Null and empty texts are
    scored on zero statistics.  Repeated rows stay; empty tables give an empty result, and without labels every score is 0.5.
    """
    rows = settle(document_statistics(docs), "quality-statistics")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("label in (0, 1)")
    train = rows.join(known.filter(~in_fold("doc_id", FOLDS, 0)), "doc_id")
    densities = fit(moments(train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(densities, x))], names=["doc_id", "score"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(
        "doc_id", in_fold("doc_id", FOLDS, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
