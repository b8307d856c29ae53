"""Linear hinge-loss models by dual coordinate descent, and scores between 0 and 1 for their margins.

Both fit on a bounded sample of labelled rows that a caller passes; scoring is the callers'.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = 1.0, epochs: int = 20, seed: int = 3, tolerance: float = 1e-3) -> np.ndarray:
    """Weights of min |w|^2 / 2 + sum_i c_i max(0, 1 - y_i w.x_i) over sparse rows (places, values).

    y is 1 or -1; c_i is ``cost``, weighed so that both classes count the same.  Each step
    solves one dual variable exactly within [0, c_i] (Hsieh et al. 2008).
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    share = {s: len(y) / (2 * max((y == s).sum(), 1)) for s in (-1, 1)}
    bound = np.array([cost * share[int(s)] for s in y])
    norm = np.array([v @ v for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(np.flatnonzero(norm > 0)).tolist():
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), bound[i])
            step = new - alpha[i]
            if step:
                w[at] += step * y[i] * v
                alpha[i] = new
                worst = max(worst, abs(step) * norm[i] ** 0.5)
        if worst < tolerance:
            break
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fitted_sigmoid(margins: np.ndarray, label: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(a, b) of score = sigmoid(a * margin + b), by Newton steps on Platt's smoothed targets; a is not negative."""
    up, down = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margins + b)
        error, weight = p - target, p * (1 - p) + 1e-9
        g = np.array([error @ margins, error.sum()])
        h = np.array([[weight @ margins**2, weight @ margins], [weight @ margins, weight.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        size = min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(float(a), 1e-3), float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, text, y) of about ``rows`` labelled training rows, all if there are fewer.

    Rows are chosen by a hash of the id, on both sides before the join, so only the sample's
    texts are shuffled.  A document with several labels counts as 1 if any is.
    """
    train = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (crc_fold("doc_id", folds) != held_out))
    share = int(1_000_000 * min(1.0, rows / max(train.count(), 1)))
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(5)), F.lit(1_000_000)) < share
    y = train.where(chosen).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    texts = docs.where(F.col("doc_id").isNotNull() & chosen).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(y, "doc_id")
