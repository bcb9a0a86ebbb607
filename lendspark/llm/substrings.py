"""Substring dedup by level-wise doubling: only windows that are repeated at one length are extended to twice that length.

Windows of half the length come first, and only those that winnowing selects: of the half windows in every whole window the one of
smallest hash, so each window has exactly one and equal windows have equal ones.  Half windows that occur under several keys are the
candidates; around them alone the windows of full length are formed and grouped on 128 bits of content.  Windows whose content
starts under a smaller key are repeated, and their words go.  ``repeat_levels`` doubles on from there until nothing survives, and
tells how long the repeats are.  Texts that equal another one as a whole are decided before any window is formed, so thousands of
copies are one text here.

Everything is a grouped minimum or a join on content: no pairs of occurrences, no group of occurrences in one task.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, map_texts, save

LENGTH = 50  # words of a window
_LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than ASCII white space, unchanged."""
    return (text or "").encode().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hashes(left: np.ndarray, right: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of the windows that follow each other: of twice the length where both are of one length."""
    with np.errstate(over="ignore"):
        return _mixed(left * _LANES[lane] + (right ^ (left >> np.uint64(29))) + np.uint64(lane + 1))


def window_hashes(h: np.ndarray, length: int, lane: int) -> np.ndarray:
    """Hash of the window of ``length`` values from each position on, by doubling; empty if there are fewer values."""
    done, size, out, power = 0, 1, None, h
    while length:
        if length & 1:
            if out is None:
                out = power
            else:
                n = max(0, len(h) - done - size + 1)
                out = join_hashes(out[:n], power[done:done + n], lane)
            done += size
        length >>= 1
        if length:
            n = max(0, len(power) - size)
            power = join_hashes(power[:n], power[size:size + n], lane)
            size *= 2
    return out


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` in a row, by doubling."""
    out, size = h, 1
    while size < width:
        step = min(size, width - size)
        out = np.minimum(out[:max(0, len(out) - step)], out[step:])
        size += step
    return out


class Hasher:
    """Word, half-window and window hashes of texts."""

    def __init__(self, length: int) -> None:
        self.length, self.half = length, length // 2
        self.known = Remembered(xxhash.xxh64_intdigest)

    def base(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        return np.fromiter((known[w] for w in tokens), dtype=np.uint64, count=len(tokens))

    def marks(self, h: np.ndarray) -> np.ndarray:
        """For every window the hash of the half window that winnowing selects in it."""
        if len(h) < self.length:
            return np.zeros(0, dtype=np.int64)
        return sliding_min(window_hashes(h, self.half, 0), self.length - self.half + 1).view(np.int64)

    def contents(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of every window."""
        return tuple(window_hashes(h, self.length, lane).view(np.int64) for lane in (0, 1))


def _own(df: DataFrame, text: str, key: str) -> DataFrame:
    own = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return own.where("key is not null and text is not null").withColumn("th", F.xxhash64("text"))


def _profile(df: DataFrame, length: int) -> DataFrame:
    """(key, th, n_words, whole, marks) of texts with a window: hash of the whole word sequence and selected half windows."""

    def make():
        hasher = Hasher(length)

        def run(texts):
            n, whole, marks = [], [], []
            for t in texts:
                tokens = words(t)
                n.append(len(tokens))
                if len(tokens) < length:
                    whole.append(None)
                    marks.append(None)
                    continue
                whole.append(blake2b(b" ".join(tokens), digest_size=16).digest())
                marks.append(np.unique(hasher.marks(hasher.base(tokens))).tolist())
            return [n, whole, marks]

        return run

    found = map_texts(df, "text", "n_words int, whole binary, marks array<long>", make)
    return found.where("whole is not null").select("key", "th", "n_words", "whole", "marks")


def _candidates(df: DataFrame, length: int, text: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts (key, th, text), those that go whole (key, th), and the marks of the others that several keys have (key, th, marks)."""
    own = _own(df, text, key)
    profile = save(_profile(own, length))
    lead = save(profile.groupBy("whole").agg(F.min("key").alias("lead")))
    profile = save(profile.join(lead, "whole").select("key", "th", "marks", (F.col("key") > F.col("lead")).alias("copy")))
    marks = profile.where("not copy").select("key", "th", F.explode("marks").alias("mark"))
    # sums before the shuffle: a mark that all texts share is one row a task
    shared = marks.groupBy("mark").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("mark")
    shared = save(shared)  # a table, not an aggregate in place, so that a join on it can be split where a key is hot
    asked = marks.join(shared, "mark").groupBy("key", "th").agg(F.collect_set("mark").alias("marks"))
    return own, profile.where("copy").select("key", "th").distinct(), asked


def _shared(own: DataFrame, asked: DataFrame, length: int, by: str) -> DataFrame:
    """(key, th, starts, later): windows of ``length`` words that start under several keys, and those of them that also start under a smaller one.

    Candidates: windows whose mark is among the text's ``marks``, or windows both halves of which start at its ``starts``.
    """

    def make():
        hasher = Hasher(length)

        def run(texts, known):
            out = []
            for t, some in zip(texts, known):
                h = hasher.base(words(t))
                some = np.asarray(some, dtype=np.int64)
                at = np.flatnonzero(np.isin(hasher.marks(h), some)) if by == "marks" else some[np.isin(some + length // 2, some)]
                a, b = hasher.contents(h)
                out.append((at.tolist(), a[at].tolist(), b[at].tolist()))
            return list(zip(*out))

        return run

    windows = map_texts(own.join(asked.select("key", "th", by), ["key", "th"]), "text", "p array<int>, a array<long>, b array<long>", make, also=(by,))
    windows = save(windows.where("size(p) > 0").select("key", "th", "p", "a", "b"))
    one = windows.select("key", "th", F.explode(F.arrays_zip("p", "a", "b")).alias("w")).select("key", "th", "w.*")
    first = one.groupBy("a", "b").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("a", "b", "low")
    found = one.join(save(first), ["a", "b"]).groupBy("key", "th").agg(
        F.array_sort(F.collect_set("p")).alias("starts"), F.array_sort(F.collect_set(F.when(F.col("key") > F.col("low"), F.col("p")))).alias("later"))
    return save(found)


def remove_repeats(df: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row of ``df`` with ``kept`` (the words left, joined by one space), n_words, n_removed and ``spans`` (deleted runs of words: first, end).

    A word is deleted if some window of ``length`` words that covers it also starts, word for word, in a row with a smaller key; windows are
    judged on the input.  Null texts have no words, rows with a null key keep all.  Rows of one key don't delete from each
    other.  Other columns pass through; those named as the results, _key, _hash, _th, _starts or _copy are replaced or left out.
    """
    if length < 2:
        raise ValueError("windows have two words or more")
    texts, copies, asked = _candidates(df, length, text, key)
    found = _shared(texts, asked, length, "marks").where("size(later) > 0")
    gone = found.select(F.col("key").alias("_key"), F.col("th").alias("_hash"), F.col("later").alias("_starts"), F.lit(False).alias("_copy"))
    gone = gone.union(copies.select("key", "th", F.lit(None).cast("array<int>"), F.lit(True)))
    own = df.drop("kept", "n_words", "n_removed", "spans", "_key", "_hash", "_starts", "_copy").withColumn("_th", F.xxhash64(F.col(text).cast("string")))
    joined = own.join(gone, (own[key] == gone["_key"]) & (own["_th"] == gone["_hash"]), "left").drop("_key", "_hash", "_th")

    def make():
        def run(texts, starts, copies):
            out = []
            for t, s, copy in zip(texts, starts, copies):
                tokens = words(t)
                spans = [(0, len(tokens))] if copy else covered(s, length) if s else []
                kept, last = [], 0
                for a, b in spans:
                    kept += tokens[last:a]
                    last = b
                kept += tokens[last:]
                out.append((b" ".join(kept).decode(), len(tokens), len(tokens) - len(kept), [{"first": a, "end": b} for a, b in spans]))
            return list(zip(*out))

        return run

    fields = "kept string, n_words long, n_removed long, spans array<struct<first: int, `end`: int>>"
    return map_texts(joined, text, fields, make, also=("_starts", "_copy")).drop("_starts", "_copy")


def covered(starts: list[int], length: int) -> list[tuple[int, int]]:
    """Runs (first, end) of the words that windows from these ascending starts on cover."""
    p = np.asarray(starts)
    cut = np.flatnonzero(np.diff(p) > length) + 1
    return [(int(a), int(b) + length) for a, b in zip(p[np.r_[0, cut]], p[np.r_[cut - 1, len(p) - 1]])]


def repeat_levels(df: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, th, length, starts, later): windows of ``length`` words that several keys have, then of twice that, until none survives.

    ``later``: those that a smaller key has.  A window of twice the length is a candidate where both of its halves survived, in
    first and later occurrences alike.  ``th`` is the hash of the text; texts that equal one of a smaller key as a whole are left out.
    """
    texts, _, asked = _candidates(df, length, text, key)
    level, out = _shared(texts, asked, length, "marks"), None
    while not level.isEmpty():  # no window outgrows the longest text, so this ends after a logarithmic number of levels
        rows = level.select("key", "th", F.lit(length).alias("length"), "starts", "later")
        out = rows if out is None else out.union(rows)
        length *= 2
        level = _shared(texts, level, length, "starts")
    return out if out is not None else level.select("key", "th", F.lit(length).alias("length"), "starts", "later")
