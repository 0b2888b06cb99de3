"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document becomes a short vector of statistics of its whole text. Per class the mean and the
covariance are estimated from summed moments, the covariances are shrunk towards the pooled one and
its diagonal, and their Cholesky factors are kept. A score is the difference of the two Mahalanobis
log-densities plus the log prior ratio, squashed to 0..1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts
from ridewright.session import cut_lineage

POOLED_SHARE = 0.3
DIAGONAL_SHARE = 0.1
FLOOR = 1e-3

# Byte classes whose share of the text is a statistic each.
BYTE_CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"|\t",
    b"!?",
    b"#$%&*@^~=+<>\\/_{}[]`",
    b".,;:",
    b"\n\r",
    bytes(range(0x80, 0xC0)),
)
CLASS_MATRIX = np.array([[b in group for group in BYTE_CLASSES] for b in range(256)], np.float64)
N_FEATURES = len(BYTE_CLASSES) + 6


def statistics(raw: bytes | None) -> np.ndarray:
    """Transformed statistics of one text; null and empty texts get the values of no words."""
    raw = raw or b""
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = histogram @ CLASS_MATRIX / max(1, len(raw))
    words = raw.split()
    n = len(words)
    pairs = max(1, n - 1)
    lines = [line for line in raw.split(b"\n") if line]
    repeated = sum(map(eq, words, words[1:])) / pairs
    new_words = len(set(words)) / max(1, n) if n else 1.0
    new_pairs = len(set(zip(words, words[1:]))) / pairs if n > 1 else 1.0
    new_lines = len(set(lines)) / len(lines) if lines else 1.0
    rest = (
        math.asin(math.sqrt(repeated)),
        math.asin(math.sqrt(1 - new_words)),
        math.asin(math.sqrt(1 - new_pairs)),
        math.asin(math.sqrt(1 - new_lines)),
        math.log1p(n),
        math.log1p(len(raw) / max(1, n)),
    )
    return np.concatenate([np.arcsin(np.sqrt(shares)), rest])


def batch_statistics(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, N_FEATURES)


@dataclass(frozen=True)
class Discriminant:
    """Class means, Cholesky factors of the class covariances, and the constant of the log ratio."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 minus class 0, with priors."""
        parts = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            parts.append(constant - 0.5 * (z * z).sum(axis=0))
        return parts[1] - parts[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """0..1, 0.5 where both classes are equally likely; asinh keeps far values apart."""
        if not len(x):
            return np.empty(0)
        return 1 / (1 + np.exp(-np.arcsinh(self.log_ratio(x))))


def from_moments(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, pooled_share: float, diagonal_share: float) -> Discriminant:
    """Fit from per-class counts, sums and sums of products. A class without rows takes the pooled values."""
    d = sums.shape[1]
    total = max(1.0, counts.sum())
    grand = sums.sum(axis=0) / total
    means = np.array([s / n if n else grand for n, s in zip(counts, sums, strict=True)])
    scatter = np.array([q - n * np.outer(m, m) for n, q, m in zip(counts, squares, means, strict=True)])
    pooled = scatter.sum(axis=0) / total
    factors, constants = [], []
    for n, own in zip(counts, scatter, strict=True):
        own = own / n if n > 1 else pooled
        mixed = (1 - pooled_share) * own + pooled_share * pooled
        mixed = (1 - diagonal_share) * mixed + diagonal_share * np.diag(np.diag(mixed)) + FLOOR * np.eye(d)
        factor = np.linalg.cholesky((mixed + mixed.T) / 2)
        factors.append(factor)
        constants.append(math.log((n + 1) / (total + 2)) - float(np.log(np.diag(factor)).sum()))
    return Discriminant(means, np.array(factors), np.array(constants))


def _as_rows(name: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch_statistics(raw_texts(batch.column(name)))
            keep = {c: batch.column(c) for c in batch.schema.names if c != name}
            yield pa.RecordBatch.from_pydict({**keep, "x": pa.array(list(x), pa.list_(pa.float64()))})

    return step


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every whole text, written once to the shared folder."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return cut_lineage(map_batches(rows, _as_rows("text"), schema))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    *,
    train: Column | None = None,
    id_col: str = "doc_id",
    label_col: str = "quality",
    pooled_share: float = POOLED_SHARE,
    diagonal_share: float = DIAGONAL_SHARE,
) -> Discriminant:
    """Fit from all labelled rows (label 0 or 1) for which ``train``, a condition on the id, holds.

    The moments are summed before the shuffle, so any number of labelled rows, also with equal ids,
    costs one pass. Null ids and labels other than 0 and 1 teach nothing. Without labels the score
    is 0.5 for every document.
    """
    chosen = labels.where(F.col(label_col).isin(0, 1))
    chosen = chosen.where(train) if train is not None else chosen
    chosen = chosen.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    x = [F.col("x")[i] for i in range(N_FEATURES)]
    pairs = [(i, j) for i in range(N_FEATURES) for j in range(i + 1)]
    rows = (
        stats.join(chosen, "id")
        .groupBy("y")
        .agg(
            F.count("*").alias("n"),
            F.array([F.sum(v) for v in x]).alias("s"),
            F.array([F.sum(x[i] * x[j]) for i, j in pairs]).alias("q"),
        )
        .collect()
    )
    counts, sums, squares = np.zeros(2), np.zeros((2, N_FEATURES)), np.zeros((2, N_FEATURES, N_FEATURES))
    for r in rows:
        counts[r.y], sums[r.y] = r.n, r.s
        for (i, j), v in zip(pairs, r.q, strict=True):
            squares[r.y, i, j] = squares[r.y, j, i] = v
    return from_moments(counts, sums, squares, pooled_share, diagonal_share)


def score_statistics(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(id, x, score) for rows of :func:`document_statistics`."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "x": batch.column("x"), "score": pa.array(model.score(x))}
            )

    return map_batches(stats, step, T.StructType([*stats.schema.fields, T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, model: Discriminant, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, all columns unchanged, whose text scores at least ``threshold``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(batch_statistics(raw_texts(batch.column(text_col))))
            yield batch.filter(pa.array(scores >= threshold))

    return map_batches(docs, step, docs.schema)
