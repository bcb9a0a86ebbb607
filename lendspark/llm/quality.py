"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text is its words and punctuation runs (lower case), their pairs and triples, each hashed to one of 2^BITS weights; equal neighbours
and equal tokens two apart also give one shared feature each, whatever the word.  Counts are scaled to unit length.  Training updates one coordinate state (z, n) for
each feature; SHARDS learners run in parallel over a bounded labelled sample and their weights are averaged.  A score is
the logistic of a sparse dot product.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, bounded_sample, empty_text, map_texts

BITS = 18
SHARDS = 4
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
_TOKEN = regex.compile(r"\w+|[^\w\s]+")
_TOP = np.uint32(32 - BITS)


class Features:
    """Hashed n-grams of texts; remembers the token hashes of recent chunks."""

    def __init__(self) -> None:
        self.chunks = Remembered(lambda c: np.array([zlib.crc32(t.encode()) for t in _TOKEN.findall(c.lower())], dtype="<u4").tobytes())

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers, ascending, and their values; the last number (2^BITS) is the constant."""
        h = np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split())), dtype="<u4")
        parts = [h * np.uint32(0x9E3779B1)]
        if len(h) > 1:
            pair = (h[:-1] * np.uint32(0x85EBCA6B)) ^ (h[1:] * np.uint32(0xC2B2AE35))
            parts.append(pair * np.uint32(0x9E3779B1))
            parts.append(np.full(int((h[:-1] == h[1:]).sum()), 0x12345678, dtype=np.uint32))
        if len(h) > 2:
            parts.append(np.full(int((h[:-2] == h[2:]).sum()), 0x9ABCDEF0, dtype=np.uint32))
            parts.append(((pair[:-1] * np.uint32(5)) ^ (h[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x9E3779B1))
        at, n = np.unique(np.concatenate(parts) >> _TOP, return_counts=True)
        value = n / np.sqrt((n.astype(np.float64) ** 2).sum()) if len(n) else n.astype(np.float64)
        return np.append(at, np.uint32(1 << BITS)).astype(np.int64), np.append(value, 1.0)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the follow-the-regularised-leader step."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(EPOCHS):
        for at, value, label in examples:
            w = weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(value @ w, -35, 35))) - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", max_rows: int = 12_000) -> np.ndarray:
    """2^BITS + 1 weights, fitted on at most ``max_rows`` labelled rows, chosen by hash: the documented bound of the fit.

    ``labels``: key and label (1 good, 0 bad; others and nulls are not learnt from).  The chosen labels are broadcast, their number
    being bounded, so texts are not shuffled before the choice.  Documents repeated in full are learnt once; where keys repeat with
    other texts, the bound is applied to the documents again.  Without any usable label all weights are 0 and every score 0.5.
    """
    known = labels.select(F.col(key).alias("k"), F.col("label").cast("int").alias("label")).where("k is not null and label in (0, 1)")
    known = known.groupBy("k").agg(F.min("label").alias("label"))
    chosen = bounded_sample(known.withColumn("all", F.lit(0)), "all", "k", max_rows).drop("all")
    rows = docs.select(F.col(key).alias("k"), empty_text(text).alias("text")).join(F.broadcast(chosen), "k")
    rows = bounded_sample(rows.withColumn("all", F.lit(0)), "all", ["k", "text"], max_rows).drop("all")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("k", F.lit(5)), F.lit(SHARDS)))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        own = Features()
        pdf = pdf.sort_values(["o", "text"])
        w = fit([(*own.of(t), label) for t, label in zip(pdf["text"], pdf["label"])])
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})

    learnt = rows.withColumn("o", F.xxhash64("k", F.lit(9))).groupBy("shard").applyInPandas(learn, "at long, w double")
    out = np.zeros((1 << BITS) + 1)
    for at, w in learnt.groupBy("at").agg(F.sort_array(F.collect_list("w")).alias("w")).collect():
        out[at] = sum(w) / SHARDS  # at most SHARDS values each, summed in a fixed order
    return out


def score(df: DataFrame, model: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """Every row of ``df`` with its probability of label 1 in ``out``; null and empty texts get the constant's.  No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        own, w = Features(), shared.value

        def one(text: str | None) -> float:
            at, value = own.of(text or "")
            return 1 / (1 + math.exp(-min(35.0, max(-35.0, float(value @ w[at])))))

        return lambda texts: [[one(t) for t in texts]]

    return map_texts(df, text, f"`{out}` double", make)
