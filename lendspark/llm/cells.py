"""Cells of vectors by spherical k-means, shared by the embedding operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample

SAMPLE = 8192  # vectors that the cells are fitted on, at most


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows) -> np.ndarray:
    """Unit vectors in double precision.  Scaling by the largest component first keeps tiny and huge vectors exact."""
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit(vectors: DataFrame, count: int, rounds: int = 8, key: str = "id", column: str = "vec") -> np.ndarray:
    """``count`` unit centroids (fewer for few vectors) by spherical k-means over a bounded sample, chosen by hash of the key.

    Only where cell borders lie depends on the sample; every vector is then assigned to a cell.
    """
    sample = bounded_sample(vectors.withColumn("_all", F.lit(0)), "_all", key, SAMPLE).select(key, column).collect()
    if not sample:
        return np.zeros((0, 0))
    x = unit([r[1] for r in sorted(sample, key=lambda r: r[0])])
    centres = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)]
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres
