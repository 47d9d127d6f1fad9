"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import holds_out


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, limit: int) -> DataFrame:
    """``(text, y)`` of at most ``limit`` labelled keys that aren't held out: those of least key hash, a uniform sample.

    A repeated key counts once, with its least label and its least text. The sample's keys (``limit`` at most) are the
    only thing that is broadcast.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("key"), F.col(label).cast("int").alias("y")).where("key is not null and y in (0, 1)")
    rows = rows.where(~holds_out("key", modulus, remainder)).groupBy("key").agg(F.min("y").alias("y")).orderBy(F.xxhash64("key"), "key").limit(limit)
    texts = documents.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(rows), "key").groupBy("key").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y")


def sigmoid(x):
    return 0.5 * (1 + np.tanh(np.asarray(x, np.float64) / 2))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a one-feature logistic fit (Newton steps, light ridge)."""
    if not len(x):
        return 0.0, 0.0
    design = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(design @ w)
        grad = design.T @ (p - y) + 1e-3 * w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])
