"""Bounded samples of labelled documents, and logistic regression on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import in_fold


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """At most about ``most`` rows of ``docs`` with their 0/1 label, outside the held-out fold: those with the least hash of the id.

    A document that is labelled more than once has its largest label. Rows without an id or label don't count.
    """
    named = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~in_fold("doc_id"))
    known = named.groupBy(F.col("doc_id").cast("long").alias("labelled_id")).agg(F.max(column).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most)
    # ``most`` rows of two numbers, whatever the tables hold.
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def weighted_sum(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    # Not a matrix product: its threads may hang in a process that has started a JVM.
    return np.einsum("ij,j->i", features, weights)


def logistic(features: np.ndarray, labels: np.ndarray, rounds: int = 300, rate: float = 0.3, decay: float = 1e-3):
    """Weights and bias by gradient descent with Adagrad steps; the columns should be of like scale."""
    weights, bias = np.zeros(features.shape[1]), 0.0
    squares, bias_square = np.full(features.shape[1], 1e-8), 1e-8
    for _ in range(rounds if len(labels) else 0):
        error = sigmoid(weighted_sum(features, weights) + bias) - labels
        step = np.einsum("ij,i->j", features, error) / len(labels) + decay * weights
        squares += step**2
        weights -= rate * step / np.sqrt(squares)
        shift = float(error.mean())
        bias_square += shift**2
        bias -= rate * shift / np.sqrt(bias_square)
    return weights, float(bias)
