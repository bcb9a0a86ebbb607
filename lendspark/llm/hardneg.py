"""Hard negatives: exact integer scores by Strassen's recursive multiplication, kept in mergeable heaps.

Anchors go out in waves of a bounded number of bytes; each wave meets every row where that row's partition lies, so candidates are never
shuffled and never repeated.  A task multiplies tiles of anchors and rows in int64 (seven half-size products instead of eight, odd
sides padded with zeros) and keeps one small heap for each anchor: first the best rows of the anchor's label, its positives; then, with
the positives' scores known, one heap for each positive's window of scores.  Heaps of one anchor from several tasks merge by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

SCALE = 256
SMALL = 32  # sides up to this are multiplied directly
TILE = 512  # anchors of a tile
ROWS = 2048  # rows of a tile
WAVE_BYTES = 32_000_000  # anchors that are sent to all tasks at once, as int64
_MOST = float(np.finfo(np.float64).max)


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices.  Additions wrap at 64 bits like products do, so the result is exact where it fits in 64 bits."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= SMALL:
        return np.einsum("mk,kn->mn", a, b)  # int64 has no BLAS; this is the fastest plain form
    if (m | k | n) & 1:
        a = np.pad(a, ((0, m & 1), (0, k & 1)))
        b = np.pad(b, ((0, k & 1), (0, n & 1)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * h), dtype=np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` (whole numbers held as doubles), int64.

    Where they could leave 64 bits they are taken in unbounded integers and cut to the range of a long.
    """
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0 ** 62:
        return strassen(a.astype(np.int64), np.ascontiguousarray(b.astype(np.int64).T))
    wide = [[[int(x) for x in row] for row in side.tolist()] for side in (a, b)]
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[max(low, min(high, sum(x * y for x, y in zip(r, s)))) for s in wide[1]] for r in wide[0]], dtype=np.int64).reshape(len(a), len(b))


def whole(vec: list[float]) -> np.ndarray:
    """floor(SCALE * x) of every component, as doubles; beyond the doubles' range the largest of them."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * np.asarray(vec, dtype=np.float64)), -_MOST, _MOST)


def _first(scores: np.ndarray, high: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, place) of the first k scores of each row within [low, high]; rows are sorted from high to low."""
    start = (scores > high[:, None]).sum(axis=1)
    at = start[:, None] + np.arange(k)[None, :]
    inside = at < scores.shape[1]
    at = np.minimum(at, scores.shape[1] - 1)
    good = inside & (np.take_along_axis(scores, at, axis=1) >= low[:, None])
    i, j = np.nonzero(good)
    return i, at[i, j]


class Heaps:
    """The k best (score, id) of each place.  What tiles bring is merged in once it outgrows what is kept, so a merge costs little an entry."""

    def __init__(self, k: int, slack: int = 50_000) -> None:
        self.k, self.slack, self.fresh = k, slack, 0
        self.parts = [(np.zeros(0, dtype=np.int64),) * 3]

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((place, score, ids))
        self.fresh += len(place)
        if self.fresh > self.slack + len(self.parts[0][0]):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, score, ids = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((ids, ~score, place))  # ~ turns the order of int64 round without overflow
        place, score, ids = place[order], score[order], ids[order]
        keep = np.arange(len(place)) - np.searchsorted(place, place) < self.k
        self.parts, self.fresh = [(place[keep], score[keep], ids[keep])], 0
        return self.parts[0]


def _rows(df: DataFrame, key: str, vector: str, label) -> DataFrame:
    """One usable row for each id: (id, label, vec)."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = df.select(F.col(key).cast("long").alias("id"), label.alias("label"), vec.alias("vec"), (vec.isNotNull() & ~bad).alias("ok"))
    own = own.where("ok and label is not null and id is not null")
    return own.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")


def _scan(rows: DataFrame, anchors: dict, same: bool, k: int) -> DataFrame:
    """(place, score, id): the heaps of every task.  ``anchors``: by vector length the matrix, labels, ids, and the places with
    their anchor (``of``) and window (``low``, ``high``)."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps = Heaps(k)
        for pdf in batches:
            lengths = pdf["vec"].map(len).to_numpy()
            for d, group in shared.value.items():
                own = pdf[lengths == d]
                for start in range(0, len(own), ROWS):
                    _tile(own.iloc[start:start + ROWS], group, same, heaps)
        yield pd.DataFrame(dict(zip(("place", "score", "id"), heaps.merge())))

    return rows.mapInPandas(run, "place long, score long, id long")


def _tile(part: pd.DataFrame, group: dict, same: bool, heaps: Heaps) -> None:
    order = np.argsort(part["id"].to_numpy(), kind="stable")
    ids, labels = part["id"].to_numpy()[order], part["label"].to_numpy()[order]
    x = np.stack([whole(v) for v in part["vec"].iloc[order]])
    if same:  # only rows of an anchor's label are multiplied with it
        for label in np.unique(group["labels"]):
            pick, some = np.flatnonzero(labels == label), np.flatnonzero(group["labels"][group["of"]] == label)
            for start in range(0, len(some) if len(pick) else 0, TILE):
                at = some[start:start + TILE]
                scores = products(group["x"][group["of"][at]], x[pick])
                _keep(scores, np.arange(len(at)), ids[pick], group["ids"][group["of"][at]], group, at, heaps, heaps.k + 1)
        return
    for start in range(0, len(group["ids"]), TILE):
        stop = min(start + TILE, len(group["ids"]))
        mine = np.flatnonzero((group["of"] >= start) & (group["of"] < stop))
        scores = products(group["x"][start:stop], x)
        for label in np.unique(group["labels"][start:stop]):
            pick = np.flatnonzero(labels != label)
            at = mine[group["labels"][group["of"][mine]] == label]
            if len(pick) and len(at):
                # an anchor is sorted once for all its windows
                who, back = np.unique(group["of"][at] - start, return_inverse=True)
                _keep(scores[np.ix_(who, pick)], back, ids[pick], None, group, at, heaps, heaps.k)


def _keep(s: np.ndarray, back: np.ndarray, ids: np.ndarray, own: np.ndarray | None, group: dict, at: np.ndarray, heaps: Heaps, k: int) -> None:
    """Add to the heaps what lies in the windows ``at``; row ``back`` of the scores belongs to each.  ``own``: ids that are no partner."""
    by = np.argsort(~s, axis=1, kind="stable")  # from high to low, ties by id as the columns are
    s = np.take_along_axis(s, by, axis=1)
    i, j = _first(s[back], group["high"][at], group["low"][at], k)
    score, who = s[back[i], j], ids[by[back[i], j]]
    if own is not None:
        fair = who != own[i]
        i, score, who = i[fair], score[fair], who[fair]
    heaps.add(group["place"][at][i], score, who)


def _best(heaps: DataFrame, k: int) -> DataFrame:
    """The k best of each place: ranks are cut in every task before the shuffle, so a place never meets whole."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, is_anchor, key: str = "vec_id", vector: str = "embedding", label="label", positives: int = 5, negatives: int = 5,
                   share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the first ``negatives`` rows of another label for each
    of an anchor's first ``positives`` rows of its own, with share[0] * positive <= share[1] * negative <= share[1] * positive.

    ``is_anchor``: a condition on the column ``id``; ``label``: a column or its name.  Components x count as floor(256 x); scores are integer inner products, higher
    first, ties by smaller id.  Rows with a null id, label or vector, or a null or non-finite component, take no part; zero
    vectors do.  Rows are compared within one vector length.  Of rows with one id the one of smallest label, then vector, is
    taken, so repeated rows count once.  Scores beyond 64 bits are cut to the range of a long.  Extra columns are ignored; without
    anchors, positives or negatives there are no rows.
    """
    spark = df.sparkSession
    rows = save(_rows(df, key, vector, F.col(label) if isinstance(label, str) else label))
    asked = rows.where(is_anchor)
    size = asked.agg(F.coalesce(F.sum(F.size("vec") * 8 + 64), F.lit(0))).first()[0]
    waves = int(size * 1.25 // WAVE_BYTES) + 1
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for wave in range(waves):
        # bounded by WAVE_BYTES, whatever the number of anchors
        own = asked.where(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(waves)) == wave).orderBy("id").collect()
        if own:
            out = out.union(_wave(rows, own, positives, negatives, share))
    return out


def _wave(rows: DataFrame, own: list, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    spark = rows.sparkSession
    info = np.iinfo(np.int64)
    groups, ids = {}, []
    for d in sorted({len(r["vec"]) for r in own}):
        some = [r for r in own if len(r["vec"]) == d]
        n, first = len(some), len(ids)
        ids += [r["id"] for r in some]
        groups[d] = {"x": np.stack([whole(r["vec"]) for r in some]), "labels": np.array([r["label"] for r in some]), "ids": np.array(ids[first:]),
                     "of": np.arange(n), "place": first + np.arange(n), "low": np.full(n, info.min), "high": np.full(n, info.max), "first": first}
    found = _best(_scan(rows, groups, True, positives), positives).orderBy("place", "rank").collect()  # ``positives`` an anchor at most
    pairs = [(r["place"], r["id"], r["score"]) for r in found]
    at = np.array([p[0] for p in pairs], dtype=np.int64)
    low = [max(info.min, -(-share[0] * s // share[1])) for _, _, s in pairs]  # rounded up
    for g in groups.values():
        mine = np.flatnonzero((at >= g["first"]) & (at < g["first"] + len(g["ids"])))
        g |= {"of": at[mine] - g["first"], "place": mine, "low": np.array([low[k] for k in mine], dtype=np.int64),
              "high": np.array([pairs[k][2] for k in mine], dtype=np.int64)}
    named = spark.createDataFrame([(k, ids[a], p, s) for k, (a, p, s) in enumerate(pairs)], "place long, anchor_id long, positive_id long, positive_score long")
    best = _best(_scan(rows, groups, False, negatives), negatives)
    return best.join(named, "place").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                            "positive_score", F.col("score").alias("negative_score"))
