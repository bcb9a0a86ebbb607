"""Line dedup: repeated runs of lines are deleted from every text but the first.

A window is the shortest run of lines from a line on, or up to a line, that has MIN_WORDS words.  Every window has a content hash and is joined with
the first position of that content; no window minima are selected and no match is extended line by line, as that needs pairs of
occurrences.  Every line of a shared run lies in a window that begins at a line of the run or in one that ends at it, so the union
of matched windows is the whole run, and it is found without comparing all pairs of its occurrences.  ``mark``, the smallest line hash of a
window, only drops windows that the join on content would drop too.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, save

MIN_WORDS = 5  # the shortest repeated run that is deleted, in words
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WINDOWS = "array<struct<a: int, b: int, mark: long, body: long>>"


def windows(text: str) -> list[dict]:
    """Windows (first and last line, fingerprint, content hash) of a text.  Lines end at a line feed and are compared without
    surrounding white space; lines without words are skipped over: they neither part a run nor count, and go with the
    line before them."""
    numbers, hashes, upto = [], [], [0]
    for k, line in enumerate(text.split("\n")):
        n = len(_WORD.findall(line))
        if n:
            numbers.append(k)
            hashes.append(xxhash.xxh64_intdigest(line.strip().encode()))
            upto.append(upto[-1] + n)
    count = len(numbers)
    numbers.append(k + 1)  # a line's share ends before the next line with words
    found = set()
    for i in range(count):
        j = bisect_left(upto, upto[i] + MIN_WORDS)  # lines i .. j - 1 have enough words
        if j <= count:
            found.add((i, j))
        j = bisect_right(upto, upto[i + 1] - MIN_WORDS) - 1  # lines j .. i have
        if j >= 0:
            found.add((j, i + 1))
    out = []
    for i, j in sorted(found):
        own = hashes[i:j]
        body = own[0] if j == i + 1 else xxhash.xxh64_intdigest(b"".join(h.to_bytes(8, "little") for h in own), 1)
        out.append({"a": numbers[i], "b": numbers[j] - 1, "mark": _signed(min(own)), "body": _signed(body)})
    return out


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def repeated_runs(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, th, gone): the line numbers to delete from each text that has any, ascending; ``th`` is the text's hash.

    First is the occurrence with the smallest key (null first), then text hash, then line.  Within one text a run counts as
    repeated only if it begins after its first occurrence ends.  Rows repeated in full are one text here.  Null and empty texts
    have no lines.  Sums before shuffles: a line that all texts share is one counter a task, and the join with first positions is
    split by adaptive skew handling.
    """
    own = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    own = own.withColumn("th", F.xxhash64("text"))

    def make():
        return lambda texts: [[windows(t) if t else [] for t in texts]]

    found = save(map_texts(own, "text", f"w {_WINDOWS}", make).select("key", "th", F.explode("w").alias("w")).select("key", "th", "w.*"))
    marks = found.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    # windows whose mark repeats, and the first position of each window's content
    place = F.struct("key", "th", "a", "b")
    first = found.groupBy("body").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = found.join(marks, "mark", "left_semi").join(first.select("body", "first"), "body")
    same = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("th") == F.col("first.th"))
    later = later.where(~same | (F.col("a") > F.col("first.b")))
    lines = later.select("key", "th", F.explode(F.sequence("a", "b")).alias("line"))
    return lines.groupBy("key", "th").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def dedup_lines(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row of ``df`` with its text cleaned, and ``n_cut``, the number of deleted lines.

    Null texts stay null, and texts without a repeated run stay as they are, byte for byte.  A text that is left without words held only
    what was seen before: it becomes empty.  Cases as for ``repeated_runs``.  Other columns pass through, those named n_cut, _key, _th, _hash
    or _gone are replaced or left out.
    """
    runs = repeated_runs(df, text, key).select(F.col("key").alias("_key"), F.col("th").alias("_hash"), F.col("gone").alias("_gone"))
    own = df.drop("n_cut", "_key", "_hash", "_gone").withColumn("_th", F.xxhash64(F.col(text).cast("string")))
    joined = own.join(runs, own[key].eqNullSafe(runs["_key"]) & (own["_th"] == runs["_hash"]), "left").drop("_key", "_hash", "_th")

    def cut(t: str | None, gone: list[int] | None) -> str | None:
        if not gone:
            return t
        drop = set(gone)
        kept = "\n".join(line for k, line in enumerate(t.split("\n")) if k not in drop)
        return kept if _WORD.search(kept) else ""

    def make():
        return lambda texts, gone: [[cut(t, g) for t, g in zip(texts, gone)], [len(g or ()) for g in gone]]

    done = map_texts(joined, text, "_cut string, n_cut int", make, also=("_gone",)).drop("_gone")
    return done.withColumn(text, F.col("_cut")).drop("_cut")
