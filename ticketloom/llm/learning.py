"""Labelled rows and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000  # labelled rows a classifier is fitted on, at most


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, label``: ids whose labels in ``column`` are 0 or 1 and agree."""
    held = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    per_id = held.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    return per_id.where("label = _most").select("doc_id", "label")


def bounded_sample(rows: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """At most ``limit`` rows, chosen by a hash of their id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Newton's method on the mean logistic loss with a ridge; one weight for each column of ``x``."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max(initial=0.0) < 1e-8:
            break
    return w
