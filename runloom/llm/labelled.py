"""Bounded labelled samples and the calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows of each class that a classifier is fitted on, and the longest text
#: (bytes) among them. Every document is scored as a whole, whatever its length.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 4000, 1 << 16
HASHES = 1 << 40


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text by ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, modulus: int, held: int, rows: int = SAMPLE_ROWS
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, labels (0 or 1) and weights of at most ``rows`` labelled documents per class.

    Documents of the held-out remainder are not among them. The rows with the least hashes
    of the key are taken, so the sample does not depend on the order of the table; weights
    restore the share of each class. Only keys are sorted; the texts are fetched by a join
    with those keys, whose number is bounded.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (remainder(key, modulus) != held))
    keys = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in keys.groupBy("_label").count().collect()}
    order = F.pmod(F.xxhash64("_key"), F.lit(HASHES))
    # Twice the wanted share of the hashes leaves enough keys, and few to sort.
    share = {y: int(HASHES * min(1.0, 2 * rows / max(1, counts.get(y, 0)))) for y in (0, 1)}
    parts = [keys.filter((F.col("_label") == y) & (order < F.lit(share[y]))).orderBy(order, "_key").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))
    wanted = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).filter(F.octet_length("_text") <= SAMPLE_TEXT_BYTES)
    found = wanted.join(chosen, F.col("_doc") == F.col("_key")).select("_key", "_text", "_label").toArrow()
    order_of = np.argsort(found.column("_key").to_numpy(), kind="stable")
    texts = [t.encode() for t in found.column("_text").take(order_of).to_pylist()]
    y = found.column("_label").to_numpy()[order_of].astype(np.int64)
    taken = np.bincount(y, minlength=2)
    weight = np.array([counts.get(k, 0) / max(1, taken[k]) for k in (0, 1)])
    return texts, y, weight[y] if len(y) else np.zeros(0)


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model, the constant last, by Newton's steps.

    With one class only, the constant says that class; without rows the score is a half.
    """
    coefficients = np.zeros(x.shape[1] + 1)
    if len(y) == 0:
        return coefficients
    if y.min() == y.max():
        coefficients[-1] = 4.0 if y[0] else -4.0
        return coefficients
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = weights / weights.mean()
    b = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        gradient = z.T @ (w * (y - p)) - ridge * len(y) * b
        hessian = (z * (w * p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(b))
        step = np.linalg.solve(hessian, gradient)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    coefficients[:-1] = b[:-1] / scale
    coefficients[-1] = b[-1] - (b[:-1] * mean / scale).sum()
    return coefficients


def probability(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ coefficients[:-1] + coefficients[-1], -30, 30)))
