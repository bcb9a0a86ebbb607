"""Near-duplicate groups by weighted Jaccard similarity of word shingles, with BagMinHash signatures.

A text is the multiset of its five-word shingles.  For every shingle, Poisson processes over dyadic weight levels ([0, 1), [1, 2), [2, 4), ...)
give points (time, weight); a level that the multiplicity covers in part keeps the points below it.  A point falls to one of
SIGNATURE components, and each component keeps its earliest time: two texts agree in a component with probability equal to their
weighted Jaccard similarity.  Processes stop at the latest time that any component still waits for.

Texts that agree in all ROWS components of one of BANDS bands are candidates: a pair of similarity 0.8 is missed with probability
(1 - 0.8^7)^45 < 3e-5, and more similar ones far less often.  Candidates are verified by their exact multiset overlap.  Texts of the same words
are one class.  Within a bucket, each class is first verified against the bucket's first one, so large groups of copies cost one
comparison a member.  Where that leaves classes of one cluster of buckets in different components, blocks of bounded size are
compared as a whole, and give a spanning forest of their links instead of pairs.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, components, forest, map_texts, mix64, save

WORDS = 5
ROWS, BANDS = 7, 45
SIGNATURE = ROWS * BANDS
BLOCK = 256  # classes on either side of a block comparison, about
_TOKEN = regex.compile(r"\w+")
_GOLDEN, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Word and shingle hashes of texts; remembers the words of recent chunks."""

    def __init__(self) -> None:
        self.chunks = Remembered(lambda c: b"".join(xxhash.xxh64_digest(w.encode()) for w in _TOKEN.findall(c.lower())), 150_000)

    def words(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def shingles(self, words: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes, ascending, and their counts; fewer than five words are one shingle."""
        w = np.frombuffer(words, dtype="<u8")
        k = min(WORDS, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            h = (h ^ w[i:i + n]) * _ODD
            h ^= h >> np.uint64(29)
        return np.unique(h, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = SIGNATURE) -> np.ndarray:
    """One row of m times for each bag (element hashes, whole-number weights); bags must not be empty."""
    doc = np.repeat(np.arange(len(bags)), [len(e) for e, _ in bags])
    element = np.concatenate([e for e, _ in bags]).astype(np.uint64)
    weight = np.concatenate([w for _, w in bags]).astype(np.float64)
    parts = []
    low, high = 0.0, 1.0
    level = 0
    while len(at := np.flatnonzero(weight > low)):
        seed = mix64(element[at] ^ mix64(np.array([level + 1], dtype=np.uint64)))
        parts.append((seed, doc[at], weight[at], np.full(len(at), low), np.full(len(at), high - low)))
        low, high, level = high, high * 2, level + 1
    seed, doc, weight, low, width = map(np.concatenate, zip(*parts))
    best = np.full(len(bags) * m, np.inf)
    time = np.zeros(len(seed))
    step = 0
    with np.errstate(over="ignore"):
        while len(seed):
            many = 1 if len(seed) > 4096 or not step else 16  # few processes left: several points each at once
            number = np.arange(step + 1, step + many + 1, dtype=np.uint64)
            a = mix64(seed[:, None] + number * _GOLDEN)
            gap = -np.log((np.right_shift(a, np.uint64(11)) + np.uint64(1)) * 2.0 ** -53) / width[:, None]
            # times are sums in one fixed order, whatever the number of points drawn at once
            times = np.empty_like(gap)
            for k in range(many):
                time = time + gap[:, k]
                times[:, k] = time
            b = mix64(a ^ _ODD)
            part = (np.right_shift(b, np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            inside = low[:, None] + (b & np.uint64(0xFFFFFFFF)) * 2.0 ** -32 * width[:, None] < weight[:, None]
            np.minimum.at(best, (doc[:, None] * m + part.astype(np.int64))[inside], times[inside])
            step += many
            live = time < best.reshape(-1, m).max(axis=1)[doc]
            seed, doc, weight, low, width, time = (x[live] for x in (seed, doc, weight, low, width, time))
    return best.reshape(-1, m)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band, told apart by the band's number."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    with np.errstate(over="ignore"):
        h = np.tile(mix64(np.arange(BANDS, dtype=np.uint64)), (len(signature), 1))
        for r in range(ROWS):
            h = mix64(h ^ bits[:, :, r])
    return h.view(np.int64)


def _signed_texts():
    own = Shingler()

    def run(texts: list[str | None]) -> list[list]:
        words = [own.words(t) if t else b"" for t in texts]
        full = [k for k, w in enumerate(words) if w]
        bags = [own.shingles(words[k]) for k in full]
        bands = dict(zip(full, band_hashes(signatures(bags)).tolist())) if bags else {}
        sizes = {k: int(bag[1].sum()) for k, bag in zip(full, bags)}
        return [[xxhash.xxh3_128_digest(w) if w else None for w in words], [bands.get(k) for k in range(len(texts))],
                [sizes.get(k) for k in range(len(texts))]]

    return run


def _verifier(similarity: float):
    def make():
        own = Shingler()
        seen: OrderedDict[str, tuple] = OrderedDict()

        def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
            if text not in seen:
                if len(seen) >= 64:
                    seen.popitem(last=False)
                seen[text] = own.shingles(own.words(text))
            return seen[text]

        def alike(one: str, other: str) -> bool:
            (a, m), (b, n) = bag(one), bag(other)
            _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            common = int(np.minimum(m[i], n[j]).sum())
            return common >= similarity * (int(m.sum()) + int(n.sum()) - common)

        return lambda texts, others: [[alike(a, b) for a, b in zip(texts, others)]]

    return make


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of classes whose exact similarity suffices.  A pair of too different sizes can't and is not read."""
    pairs = pairs.join(classes.select(F.col("id").alias("a"), F.col("size").alias("na")), "a").join(
        classes.select(F.col("id").alias("b"), F.col("size").alias("nb")), "b")
    pairs = pairs.where(F.least("na", "nb") >= similarity * F.greatest("na", "nb")).select("a", "b")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return map_texts(both, "text_a", "alike boolean", _verifier(similarity), also=("text_b",)).where("alike").select("a", "b")


def overlaps(one: list[tuple[np.ndarray, np.ndarray]], other: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Multiset overlap of every bag of one list with every bag of the other, over the shingles that they share."""
    def flat(bags):
        owner = np.repeat(np.arange(len(bags)), [len(e) for e, _ in bags])
        e, n = np.concatenate([e for e, _ in bags]), np.concatenate([n for _, n in bags])
        order = np.argsort(e, kind="stable")
        return e[order], n[order], owner[order]

    (e, n, i), (f, m, j) = flat(one), flat(other)
    low, high = np.searchsorted(f, e, "left"), np.searchsorted(f, e, "right")
    out = np.zeros(len(one) * len(other))
    many = high - low
    hit = np.flatnonzero(many)
    ends = np.cumsum(many[hit])
    start = 0
    while start < len(hit):  # a few million meetings at a time
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 4_000_000, "right")))
        part = hit[start:stop]
        k = many[part]
        left = np.repeat(part, k)
        right = np.repeat(low[part], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        out += np.bincount(i[left] * len(other) + j[right], weights=np.minimum(n[left], m[right]), minlength=len(out))
        start = stop
    return out.reshape(len(one), len(other))


def _block_links(placed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b), as spanning forests, between classes of one cluster that are in different components.

    ``placed``: cluster, c (component), id.  Large components fill blocks of their own, which are not compared with each other;
    the rest of a cluster shares blocks.  A pair of blocks is one group.
    """
    sizes = placed.groupBy("cluster", "c").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") >= BLOCK // 2).select("cluster", "c", F.col("c").alias("own"), F.ceil(F.col("n") / BLOCK).alias("k"))
    small = sizes.where(F.col("n") < BLOCK // 2).groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).alias("ks"))
    blocks = placed.join(large, ["cluster", "c"], "left").join(small, "cluster", "left")
    blocks = save(blocks.select("cluster", "c", "id", F.coalesce("own", F.lit(-1)).alias("own"),
                                F.pmod(F.xxhash64("id"), F.coalesce("k", "ks")).alias("block")))
    names = blocks.select("cluster", "own", "block").distinct()
    one = names.select("cluster", F.struct("own", "block").alias("x"))
    pairs = one.join(one.withColumnRenamed("x", "y"), "cluster").where("x <= y and (x.own = -1 or x.own <> y.own)")
    rows = blocks.join(texts, "id").withColumn("x", F.struct("own", "block"))
    left = pairs.join(rows, ["cluster", "x"]).select("cluster", "x", "y", F.lit(0).alias("side"), "id", "c", "text")
    right = pairs.join(rows.withColumnRenamed("x", "y"), ["cluster", "y"]).select("cluster", "x", "y", F.lit(1).alias("side"), "id", "c", "text")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own = Shingler()
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        bags = [[own.shingles(own.words(t)) for t in s["text"]] for s in (a, b)]
        common = overlaps(*bags)
        na, nb = (np.array([n.sum() for _, n in side]) for side in bags)
        near = common >= similarity * (na[:, None] + nb[None, :] - common)
        near &= a["c"].to_numpy()[:, None] != b["c"].to_numpy()[None, :]
        i, j = np.nonzero(near)
        ids = np.concatenate([a["id"].to_numpy(), b["id"].to_numpy()])
        nodes = np.unique(ids)
        low = forest(np.searchsorted(nodes, a["id"].to_numpy()[i]), np.searchsorted(nodes, b["id"].to_numpy()[j]), len(nodes))
        moved = low != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[low[moved]], "b": nodes[moved]})

    return left.union(right).groupBy("cluster", "x", "y").applyInPandas(compare, "a long, b long")


def near_duplicates(df: DataFrame, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, th (the text's hash), group_id (smallest key of its group), kept (the row that stands for the group), n_words.

    A group is a connected component of texts linked by a weighted Jaccard similarity of ``similarity`` or more.  The row of smallest key
    is kept (then smallest text hash; null keys last).  Null texts and texts without words are groups of their own, and kept.
    Of rows repeated with key and text, null keys included, one is kept.  Extra columns are ignored; an empty table gives none.
    """
    own = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    signed = map_texts(own, "text", "digest binary, bands array<long>, size long", _signed_texts).drop("text")
    signed = save(signed.withColumn("row", F.monotonically_increasing_id()))  # saved, so the numbers stay
    place = F.struct(F.col("key").isNull().alias("none"), "key", "th", "row")
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min(place).alias("first"), F.max("size").alias("size"), F.first("bands").alias("bands"))
    classes = save(classes.withColumn("id", F.monotonically_increasing_id()))  # saved, so the numbers stay
    banded = classes.select("id", F.explode("bands").alias("h"))
    leaders = banded.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("h", "a")
    stars = save(banded.join(leaders, "h").where("id <> a").select("a", F.col("id").alias("b")).distinct())
    wanted = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes, "id").select(
        "id", F.col("first.key").alias("k"), F.col("first.th").alias("t"))
    texts = own.join(wanted, own["key"].eqNullSafe(wanted["k"]) & (own["th"] == wanted["t"])).groupBy("id").agg(F.first("text").alias("text"))
    texts = save(texts)
    spark = df.sparkSession
    links = save(_verified(stars, classes, texts, similarity))
    # clusters of buckets that the comparison with their first classes has left in several components
    cluster = components(spark, stars).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    found = components(spark, links).select(F.col("node").alias("id"), F.col("component").alias("c"))
    placed = save(cluster.join(found, "id", "left").select("id", "cluster", F.coalesce("c", "id").alias("c")))
    mixed = placed.groupBy("cluster").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("cluster")
    more = save(_block_links(placed.join(mixed, "cluster", "left_semi"), texts, similarity))
    found = components(spark, links.union(more)).select(F.col("node").alias("id"), "component")
    whole = classes.select("id", "digest", "first").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lead = whole.groupBy("component").agg(F.min("first").alias("lead"))
    group = whole.join(lead, "component").select("digest", "lead")
    return signed.join(group, "digest", "left").select(
        F.col("key").alias(key), "th",
        F.when(F.col("lead").isNull(), F.col("key")).otherwise(F.col("lead.key")).alias("group_id"),
        (F.col("lead").isNull() | (F.col("row") == F.col("lead.row"))).alias("kept"),
        F.coalesce("size", F.lit(0)).cast("long").alias("n_shingles"))


def drop_near_duplicates(df: DataFrame, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stand for their groups; same columns.  Cases as for ``near_duplicates``.

    Of rows that repeat key and text the one whose columns have the smallest hash stays: a grouped minimum over only such rows.
    """
    found = near_duplicates(df, similarity, text, key).where("n_shingles > 0")
    state = found.groupBy(F.col(key).alias("_key"), F.col("th").alias("_th")).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    state = save(state.where("not kept or n > 1"))
    twice = state.where("kept")
    own = F.xxhash64(df[text].cast("string"))
    once = df.join(state, df[key].eqNullSafe(state["_key"]) & (own == state["_th"]), "left_anti")
    again = df.join(twice, df[key].eqNullSafe(twice["_key"]) & (own == twice["_th"]), "left_semi")
    order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])
    first = again.groupBy(df[key].alias("_key"), own.alias("_th")).agg(F.min_by(F.struct("*"), order).alias("_row"))
    return once.union(first.select("_row.*"))
