"""Gradient-boosted trees on binned rows, with missing values.

Rows are binned once (up to 255 quantile bins a feature, one code for missing) and packed into blocks of binary columns, written as a
table.  A level of a tree is one job, for all settings of a grid together: every task adds up the gradients and hessians of its rows per node, feature and bin, and
only these sums leave it.  They are whole numbers of 2^-20, so a total doesn't depend on the order of its parts and neither
does the tree.  The driver sees sums of (nodes x features x bins), never rows, and picks the splits: for each cut the missing rows go to the side with
the larger gain, leaves weigh -G / (H + lambda).  Blocks with their margins stay on the executors: the first job of a tree
adds the tree before to them as it reads them, so no job replays older trees.  They are checkpointed every few trees, so lost executors recompute no more than that.

A job a level costs more than it saves on few rows.  Up to ``LOCAL_BYTES`` of packed rows are broadcast instead, and a task for each setting
grows all its trees, from the same whole numbers and so the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import checkpointed, delete_files, materialize

BINS = 255  # codes of values; code 255 is a missing value
MISSING = 255
BLOCK_ROWS = 8192
GROUP_BLOCKS = 32  # blocks that a reader holds at once
ACCURACY = 10_000
REFRESH = 20  # trees between two checkpoints of margins
TASK_BLOCKS = 128  # blocks of a task
JOINED = 8  # blocks that tasks go through at once
LOCAL_BYTES = 64_000_000  # packed blocks up to so many bytes are broadcast, and a task for each setting grows all its trees: a level is a pass there, not a job
PIECE_ROWS = 1 << 16  # rows that such a task goes through at once
FAN_IN = 32  # partial sums that one task, or the driver, adds up
_UNIT = float(1 << 20)
_BLOCK = "n long, codes binary, label binary, margin binary"
_NODE = [("feature", np.int32), ("cut", np.float64), ("bin", np.int32), ("null_left", np.bool_), ("value", np.float64), ("cover", np.float64),
         ("gain", np.float64)]


def fit_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, np.ndarray]:
    """Upper bounds of the bins of each feature, ascending and distinct: quantiles of one sketch a feature, exact up to ACCURACY values.

    Only where bins end depends on the sketch; sums over them are exact.
    """
    probs = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    values = {f: F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in features}
    row = df.agg(*[F.percentile_approx(v, probs, ACCURACY).alias(f"q{i}") for i, v in enumerate(values.values())]).first()
    found = {f: np.unique(np.array(row[i] or [], dtype=np.float64)) for i, f in enumerate(features)}
    return {f: c[np.isfinite(c)] for f, c in found.items()}


def partitions(df: DataFrame, count: int) -> int:
    """For an iterative fit over ``count`` rows: all cores, but no tiny tasks and none with more than 32 blocks."""
    return max(count // (32 * BLOCK_ROWS) + 1, min(df.sparkSession.sparkContext.defaultParallelism, count // BLOCK_ROWS + 1))


def dealt(blocks: DataFrame, count: int) -> RDD:
    """The blocks as dicts, dealt evenly: as many partitions as there are cores, or a multiple of them for more than TASK_BLOCKS a task.

    Iterative fits read them in hundreds of small jobs, which need no plan this way."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    parts = min(cores * -(-count // (cores * TASK_BLOCKS * BLOCK_ROWS)), count // BLOCK_ROWS + 1)
    return blocks.repartition(max(parts, 1)).rdd.map(lambda r: r.asDict()).mapPartitions(_joined)


def _joined(rows: Iterator[dict]) -> Iterator[dict]:
    """Every JOINED blocks as one, as sums over many nodes cost more than those over few rows."""
    rows = iter(rows)
    while held := list(islice(rows, JOINED)):
        parts = {c: [np.frombuffer(r[c], dtype=t).reshape(-1, r["n"]) for r in held] for c, t in (("codes", np.uint8), ("label", np.uint8), ("margin", np.int64))}
        yield {"n": sum(r["n"] for r in held), **{c: np.concatenate(p, axis=1).tobytes() for c, p in parts.items()}}


def as_matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows x width doubles; a null is NaN."""
    flat = column.flatten()
    return flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width) if len(flat) else np.zeros((len(column), width))


def vector_of(features: Sequence[str]):
    """The features as one array of doubles, nulls kept."""
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features])


def pack(df: DataFrame, features: Sequence[str], cuts: dict[str, np.ndarray], label, models: int, count: int, key=None) -> DataFrame:
    """Blocks of binned rows with a margin of 0 for each of ``models``, written; rows without a label are left out.

    ``count``: about as many rows, so that few rows make few blocks.  With ``key``, a long, blocks hold it in place of margins."""
    rows = df.select(vector_of(features).alias("x"), label.cast("int").alias("y"), *([] if key is None else [key.alias("k")])).where("y is not null")
    rows = rows.coalesce(partitions(df, count))  # never more than there are
    bounds = [cuts[f] for f in features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block(parts):
            x, y, *k = (np.concatenate(p) for p in zip(*parts))
            codes = np.empty((len(bounds), len(x)), dtype=np.uint8)
            for f, b in enumerate(bounds):
                at = np.minimum(np.searchsorted(b, x[:, f], side="left"), BINS - 1)  # bin k: above bound k - 1, up to bound k
                codes[f] = np.where(np.isnan(x[:, f]), MISSING, at)
            parts = (codes, y.astype(np.uint8), k[0] if k else np.zeros(models * len(x)))
            return pa.RecordBatch.from_arrays([pa.array([len(x)]), *(pa.array([p.tobytes()], type=pa.binary()) for p in parts)],
                                              names=["n", "codes", "label", "margin"])

        for batch in batches:
            held.append((as_matrix(batch.column(0), len(bounds)), *(c.to_numpy() for c in batch.columns[1:])))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    return materialize(rows.mapInArrow(run, _BLOCK), GROUP_BLOCKS)


def walk_of(tree: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """What ``grown`` needs of a tree: levels, the feature of each node, and the next node for each node and code (leaves stay)."""
    inner = np.flatnonzero(tree["feature"] >= 0)
    left = np.arange(256) <= tree["bin"][inner, None]
    left[:, MISSING] = tree["null_left"][inner]
    following = np.repeat(np.arange(len(tree)), 256).reshape(-1, 256)
    following[inner] = 2 * inner[:, None] + 2 - left  # children of node k are 2 k + 1 and 2 k + 2
    return int(inner.max(initial=-1) + 1).bit_length(), np.maximum(tree["feature"], 0).astype(np.int64), following.ravel()


def grown(walk: tuple[int, np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """The node of each row (columns of ``codes``)."""
    levels, feature, following = walk
    n = codes.shape[1]
    at, rows, flat, start = np.zeros(n, dtype=np.int64), np.arange(n), codes.ravel(), feature * n
    for _ in range(levels):
        at = following.take(at * 256 + flat.take(start.take(at) + rows))
    return at


def _unpacked(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (features x rows), labels, margins (models x rows)."""
    n = row["n"]
    return np.frombuffer(row["codes"], dtype=np.uint8).reshape(width, n), np.frombuffer(row["label"], dtype=np.uint8), np.frombuffer(row["margin"]).reshape(-1, n)


def _sums(row: dict, width: int, models: list[tuple]) -> np.ndarray:
    """The sums of one block, see ``histograms``; flat."""
    all_codes, y, margins = _unpacked(row, width)
    out = []
    for number, ratio, walk, asked in models:
        place = np.full(len(walk[1]), -1)
        place[asked] = np.arange(len(asked))
        slot, codes, margin = place[grown(walk, all_codes)], all_codes, margins[number]
        here = np.flatnonzero(slot >= 0)
        y_ = y
        if len(here) < row["n"]:
            codes, slot, margin, y_ = codes.take(here, axis=1), slot[here], margin[here], y[here]
        p = 1.0 / (1.0 + np.exp(-margin))
        w = np.where(y_ == 1, ratio * _UNIT, _UNIT)
        gh = np.rint((p - y_) * w), np.rint(p * (1.0 - p) * w)
        size = len(asked) * 256
        base = slot * 256
        total = np.empty((2, width, size))
        for f in range(width):
            key = base + codes[f]
            for k in range(2):
                total[k, f] = np.bincount(key, weights=gh[k], minlength=size)
        out.append(total.ravel())
    return np.concatenate(out)


def histograms(blocks: RDD, width: int, models: list[tuple]) -> list[np.ndarray]:
    """For each model (number, weight of positives, unfinished tree, nodes asked for) the sums of these nodes:
    (nodes, features, 256, 2) gradients and hessians in units of 2^-20.  One job for all models."""

    def run(rows) -> Iterator[np.ndarray]:
        total, ready = None, [(number, ratio, walk_of(tree), asked) for number, ratio, tree, asked in models]
        for row in rows:
            own = _sums(row, width, ready)
            total = own if total is None else total + own
        if total is not None:
            yield total

    found = total_of(blocks.mapPartitions(run))
    if found is None:
        found = np.zeros(sum(len(m[3]) for m in models) * 2 * width * 256)
    ends = np.cumsum([len(m[3]) * 2 * width * 256 for m in models])[:-1]
    return [h.reshape(2, width, -1, 256).transpose(2, 1, 3, 0) for h in np.split(found, ends)]


def total_of(sums: RDD) -> np.ndarray | None:
    """The sum of arrays, one a partition.  Beyond FAN_IN of them they are added up in tasks first, a tree of sums."""
    while (parts := sums.getNumPartitions()) > FAN_IN:
        fewer = -(-parts // FAN_IN)
        keyed = sums.mapPartitionsWithIndex(lambda i, arrays, fewer=fewer: ((i % fewer, a) for a in arrays))
        sums = keyed.reduceByKey(np.add, fewer).values()
    total = None
    for a in sums.collect():
        total = a if total is None else total + a
    return total


def add_up(sums: DataFrame, parts: int) -> np.ndarray | None:
    """The sum of all arrays in the only column of ``sums``, one a partition.  Beyond FAN_IN of them they are added up in tasks first, a tree of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                a = np.frombuffer(blob)
                total = a.copy() if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["h"])

    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        sums = sums.repartition(parts).mapInArrow(run, "h binary")
    total = None
    for (blob,) in sums.collect():
        a = np.frombuffer(blob)
        total = a.copy() if total is None else total + a
    return total


def best_splits(hist: np.ndarray, reg_lambda: float, min_child: float, usable: np.ndarray) -> tuple:
    """Per node the split of largest gain: (gain, feature, bin, null_left, G and H of either side, G, H).

    ``usable``: (features, 256) bins that end at a bound.  Of equal gains the first feature, the lowest bin, and missing to the right.
    """
    h = hist / _UNIT
    total = h[:, 0].sum(axis=1)  # the same for every feature
    left = np.cumsum(h[:, :, :MISSING], axis=2)
    missing = h[:, :, MISSING:]
    sides = np.stack([left, left + missing], axis=3)  # (node, feature, bin, side of the missing, g or h)
    g, q = sides[..., 0], sides[..., 1]
    allg, allh = total[:, None, None, None, 0], total[:, None, None, None, 1]
    fair = (q >= min_child) & (allh - q >= min_child) & usable[None, :, :MISSING, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (q + reg_lambda) + (allg - g) ** 2 / (allh - q + reg_lambda) - allg ** 2 / (allh + reg_lambda)
    gain = np.where(fair, gain, -np.inf)
    n = len(h)
    at = gain.reshape(n, -1).argmax(axis=1)
    feature, bin_, null_left = np.unravel_index(at, gain.shape[1:])
    pick = np.arange(n), feature, bin_, null_left
    return gain[pick], feature, bin_, null_left, g[pick], q[pick], total[:, 0], total[:, 1]


class _Tree:
    """A tree that grows level by level.  Of two siblings only the lighter one is summed over the rows; the other is the difference to their parent."""

    def __init__(self, depth: int, rate: float, reg_lambda: float, min_child: float, cuts: list[np.ndarray]) -> None:
        self.depth, self.rate, self.reg_lambda, self.min_child, self.cuts = depth, rate, reg_lambda, min_child, cuts
        self.nodes = np.zeros((1 << (depth + 1)) - 1, dtype=_NODE)
        self.nodes["feature"] = -1
        self.usable = np.zeros((len(cuts), 256), dtype=bool)
        for f, c in enumerate(cuts):
            self.usable[f, :len(c)] = True
        self.level, self.sums, self.asked = 0, {}, [0] if depth else []

    def grow(self, found: np.ndarray) -> None:
        """One level, from the sums of the nodes in ``asked``; afterwards ``asked`` has those of the next level, or none."""
        tree, sums = self.nodes, dict(zip(self.asked, found))
        for node in self.asked if self.level else []:
            parent, other = (node - 1) // 2, node - 1 if node % 2 == 0 else node + 1
            sums[other] = self.sums[parent] - sums[node]
        nodes = sorted(sums)
        gain, feature, bin_, null_left, gl, hl, g, h = best_splits(np.stack([sums[k] for k in nodes]), self.reg_lambda, self.min_child, self.usable)
        if self.level == 0:
            tree[0]["value"], tree[0]["cover"] = -self.rate * g[0] / (h[0] + self.reg_lambda) if h[0] > 0 else 0.0, h[0]
        self.level, self.sums, self.asked = self.level + 1, sums, []
        for k in np.flatnonzero(gain > 1e-6):
            node, f = nodes[k], feature[k]
            tree[node] = (f, self.cuts[f][bin_[k]], bin_[k], bool(null_left[k]), tree[node]["value"], tree[node]["cover"], gain[k])
            for child, a, b in ((2 * node + 1, gl[k], hl[k]), (2 * node + 2, g[k] - gl[k], h[k] - hl[k])):
                tree[child]["value"], tree[child]["cover"] = -self.rate * a / (b + self.reg_lambda), b
            if self.level < self.depth:
                self.asked.append(2 * node + 1 if 2 * hl[k] <= h[k] else 2 * node + 2)


def own_cuts(trees: np.ndarray, width: int) -> list[np.ndarray]:
    """The cuts that the trees make on each feature, ascending and distinct."""
    return [np.unique(trees["cut"][trees["feature"] == f]) for f in range(width)]


def coded(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """(features x rows): how many of a feature's cuts are below the value; the largest number of the type where it is missing."""
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < MISSING else np.uint16
    out = np.empty((len(cuts), len(x)), dtype=kind)
    for f, c in enumerate(cuts):
        out[f] = np.where(np.isnan(x[:, f]), np.iinfo(kind).max, np.searchsorted(c, x[:, f], side="left"))
    return out


def recoded(trees: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The trees with bins that count ``cuts``, as ``coded`` rows do."""
    trees = trees.copy()
    for f, c in enumerate(cuts):
        here = trees["feature"] == f
        trees["bin"][here] = np.searchsorted(c, trees["cut"][here])
    return trees


@dataclass
class BoostedTrees:
    """A fitted ensemble; ``trees`` (trees, nodes) with leaf values already scaled by the learning rate."""

    name: str
    features: list[str]
    trees: np.ndarray
    config: dict = field(default_factory=dict)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of ``x``; NaN is missing."""
        total = np.zeros(len(x))
        cuts = own_cuts(self.trees, len(self.features))
        codes = coded(cuts, x)
        if codes.dtype == np.uint8:
            for tree in recoded(self.trees, cuts):
                total += tree["value"].take(grown(walk_of(tree), codes))
            return total
        rows = np.arange(len(x))
        void = np.isnan(x)
        for tree in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                f = tree["feature"][at]
                inner = f >= 0
                if not inner.any():
                    break
                f = np.maximum(f, 0)
                left = np.where(void[rows, f], tree["null_left"][at], x[rows, f] <= tree["cut"][at])
                at = np.where(inner, 2 * at + 2 - left, at)
            total += tree["value"][at]
        return total

    def margins_moved(self, x: np.ndarray, moved: np.ndarray) -> Iterator[np.ndarray]:
        """The log-odds of the rows of ``x``, and then, feature by feature, those with this feature's column of ``moved``.

        Only trees that split on the feature are walked again."""
        cuts = own_cuts(self.trees, len(self.features))
        codes, others = coded(cuts, x), coded(cuts, moved)
        if codes.dtype != np.uint8:
            yield self.margins(x)
            for f in range(len(self.features)):
                swapped = x.copy()
                swapped[:, f] = moved[:, f]
                yield self.margins(swapped)
            return
        trees = recoded(self.trees, cuts)
        walks = [walk_of(tree) for tree in trees]
        values = np.array([tree["value"].take(grown(walk, codes)) for tree, walk in zip(trees, walks)]).reshape(len(trees), len(x))
        yield values.sum(axis=0)
        for f in range(len(self.features)):
            own = np.flatnonzero((trees["feature"] == f).any(axis=1))
            held, codes[f], before = values[own], others[f], codes[f].copy()
            for t in own:
                values[t] = trees[t]["value"].take(grown(walks[t], codes))
            yield values.sum(axis=0)
            values[own], codes[f] = held, before

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the probability of class 1 in ``out``."""
        return scored_by(df, self.features, out, lambda x: 1.0 / (1.0 + np.exp(-self.margins(x))))

    def importances(self) -> dict[str, float]:
        """Mean gain of a feature's splits, normalized to 1 in all; 0 for features that split nothing."""
        f, gain = self.trees["feature"].ravel(), self.trees["gain"].ravel()
        inner = f >= 0
        n = np.bincount(f[inner], minlength=len(self.features))
        mean = np.bincount(f[inner], weights=gain[inner], minlength=len(self.features)) / np.maximum(n, 1)
        return dict(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))

    def leaves(self) -> list:
        """(value, [(feature, low, high, share of cover, missing passes)]) of every leaf, for attributions."""
        out = []
        for tree in self.trees:
            stack = [(0, {})]
            while stack:
                node, conds = stack.pop()
                f = int(tree["feature"][node])
                if f < 0:
                    out.append((float(tree["value"][node]), [(i, *c) for i, c in sorted(conds.items())]))
                    continue
                cut, null_left = float(tree["cut"][node]), bool(tree["null_left"][node])
                low, high, share, void = conds.get(f, (-np.inf, np.inf, 1.0, True))
                for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
                    part = share * float(tree["cover"][child] / max(tree["cover"][node], 1e-300))
                    bounds = (low, min(high, cut)) if left else (max(low, cut), high)
                    stack.append((child, {**conds, f: (*bounds, part, void and null_left == left)}))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """The node table, and one row of settings."""
        rows = [(t, k, *[v.item() for v in node]) for t, tree in enumerate(self.trees) for k, node in enumerate(tree)]
        names = "tree int, node int, feature int, cut double, bin int, null_left boolean, value double, cover double, gain double"
        spark.createDataFrame(rows, names).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"name": self.name, "features": self.features, "config": self.config, "shape": list(self.trees.shape)})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()[0])
        trees = np.zeros(meta["shape"], dtype=_NODE)
        for r in spark.read.parquet(f"{path}/nodes").collect():  # trees x 2^(depth + 1) rows
            trees[r["tree"], r["node"]] = tuple(r)[2:]
        return BoostedTrees(meta["name"], meta["features"], trees, meta["config"])


def scored_by(df: DataFrame, features: Sequence[str], out: str, of, missing: Sequence[float] | None = None) -> DataFrame:
    """``df`` with ``of`` (rows x features, NaN for null) in a new column, in Arrow batches; other columns pass through unchanged."""
    df = df.drop(out)
    kept = list(df.columns)
    fields = [*df.schema.fields, T.StructField(out, T.DoubleType())]
    width, fill = len(features), None if missing is None else np.asarray(missing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(len(kept)), width)
            if fill is not None:
                x = np.where(np.isnan(x), fill, x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(of(x), type=pa.float64())], names=[*kept, out])

    return df.withColumn("_x", vector_of(features)).select(*[F.col(f"`{c}`") for c in kept], "_x").mapInArrow(run, T.StructType(fields))


def train_boosted(train: DataFrame, features: Sequence[str], n_trees: int = 300, max_depth: int = 4, learning_rate: float = 0.05, imbalance: str = "pos_weight",
                  target: str = K.TARGET, reg_lambda: float = 1.0, min_child: float = 1.0, name: str = "gbt", cuts: dict[str, np.ndarray] | None = None) -> BoostedTrees:
    """One model of ``train_boosted_grid``."""
    return train_boosted_grid(train, features, [{"max_depth": max_depth, "learning_rate": learning_rate, "imbalance": imbalance}], n_trees, target,
                              reg_lambda, min_child, name, cuts)[0]


def train_boosted_grid(train: DataFrame, features: Sequence[str], settings: Sequence[dict], n_trees: int = 300, target: str = K.TARGET,
                       reg_lambda: float = 1.0, min_child: float = 1.0, name: str = "gbt", cuts: dict[str, np.ndarray] | None = None) -> list[BoostedTrees]:
    """Logistic boosting from margin 0, a model for each of ``settings`` (max_depth, learning_rate, imbalance), all in the same scans.

    ``imbalance``: "pos_weight" weighs positives by negatives per positive, "none" doesn't.  Nulls and NaN are missing values of their own.
    ``cuts``: those of ``fit_cuts`` for the same rows, where several fits share them.  Without rows, or with one class, trees have no splits.  Jobs: ``n_trees`` x the largest depth, whatever the number of settings; for few rows one.
    """
    settings = [{"max_depth": 4, "learning_rate": 0.05, "imbalance": "pos_weight", **s} for s in settings]
    if any(s["imbalance"] not in ("pos_weight", "none") for s in settings):
        raise ValueError("boosted trees take imbalance 'pos_weight' or 'none'")
    features = list(features)
    n, pos = train.where(F.col(target).isNotNull()).agg(F.count("*"), F.count_if(F.col(target) == 1)).first()
    ratios = [1.0 if s["imbalance"] == "none" else (n - pos) / max(pos, 1) for s in settings]
    cuts = cuts or fit_cuts(train, features)
    bounds = [cuts[f] for f in features]
    blocks = pack(train, features, cuts, (F.col(target) == 1).cast("int"), len(settings), n)
    made = [((s["max_depth"], s["learning_rate"], reg_lambda, min_child, bounds), ratio) for s, ratio in zip(settings, ratios)]
    if n * (len(features) + 9) <= LOCAL_BYTES:
        done = _grown_in_tasks(blocks, len(features), made, n_trees)
    else:
        done = _grown_by_jobs(dealt(blocks, n).persist(StorageLevel.MEMORY_AND_DISK), len(features), made, n_trees, train.sparkSession)
    return [BoostedTrees(name, features, np.stack(own) if own else np.zeros((0, 1), dtype=_NODE), {"n_trees": n_trees, **s}) for own, s in zip(done, settings)]


def _grown_by_jobs(blocks: RDD, width: int, made: list[tuple], n_trees: int, spark: SparkSession) -> list[list[np.ndarray]]:
    """The trees of every setting (arguments of a tree, weight of positives); a job a level over persisted blocks."""
    done: list[list[np.ndarray]] = [[] for _ in made]
    before = written = None  # the blocks that the present ones are made of, and their last checkpoint
    try:
        for t in range(n_trees):
            growing = [_Tree(*args) for args, _ in made]
            while some := [k for k, tree in enumerate(growing) if tree.asked]:
                models = [(k, made[k][1], growing[k].nodes, growing[k].asked) for k in some]
                for k, found in zip(some, histograms(blocks, width, models)):
                    growing[k].grow(found)
                if before is not None:  # the first job has made the present blocks
                    before.unpersist()
                    before = None
            for own, tree in zip(done, growing):
                own.append(tree.nodes)
            if t + 1 < n_trees:
                before, blocks = blocks, _advanced(blocks, width, [tree.nodes for tree in growing])
                if (t + 1) % REFRESH == 0:
                    checkpointed(blocks, spark)
                    delete_files(spark, written)
                    written = blocks.getCheckpointFile()
    finally:
        for rdd in (blocks, before):
            if rdd is not None:
                rdd.unpersist()
        delete_files(spark, written)
    return done


def _grown_in_tasks(blocks: DataFrame, width: int, made: list[tuple], n_trees: int) -> list[list[np.ndarray]]:
    """The same trees, each setting's by one task, over broadcast rows."""
    context = blocks.sparkSession.sparkContext
    rows = blocks.select("n", "codes", "label").collect()  # LOCAL_BYTES at most
    codes = np.concatenate([np.frombuffer(r.codes, dtype=np.uint8).reshape(width, r.n) for r in rows], axis=1) if rows else np.zeros((width, 0), dtype=np.uint8)
    shared = context.broadcast((codes, np.frombuffer(b"".join(r.label for r in rows), dtype=np.uint8)))

    def run(made: tuple) -> list[np.ndarray]:
        args, ratio = made
        return _grown_here(*shared.value, lambda: _Tree(*args), ratio, n_trees)

    try:
        return context.parallelize(made, len(made)).map(run).collect()
    finally:
        shared.destroy()


class _Piece:
    """Some rows and where they are in the tree that grows.  Gradients are taken once a tree, and rows go on by a level at a time."""

    def __init__(self, codes: np.ndarray, label: np.ndarray, ratio: float) -> None:
        self.codes, self.flat, self.rows = codes, codes.ravel(), np.arange(codes.shape[1])
        self.y, self.w = label, np.where(label == 1, ratio * _UNIT, _UNIT)
        self.margin = np.zeros(len(label))

    def start(self) -> None:
        p = 1.0 / (1.0 + np.exp(-self.margin))
        self.gh = np.rint((p - self.y) * self.w), np.rint(p * (1.0 - p) * self.w)
        self.at = np.zeros(len(self.y), dtype=np.int64)

    def sums(self, place: np.ndarray, size: int) -> np.ndarray:
        slot, codes, gh = place[self.at], self.codes, self.gh
        here = np.flatnonzero(slot >= 0)
        if len(here) < len(slot):
            slot, codes, gh = slot[here], codes.take(here, axis=1), [v[here] for v in gh]
        base, total = slot * 256, np.empty((2, len(codes), size))
        for f, c in enumerate(codes):
            key = base + c
            for k in range(2):
                total[k, f] = np.bincount(key, weights=gh[k], minlength=size)
        return total

    def step(self, walk: tuple[int, np.ndarray, np.ndarray]) -> None:
        _, feature, following = walk
        self.at = following.take(self.at * 256 + self.flat.take(feature.take(self.at) * len(self.rows) + self.rows))


def _grown_here(codes: np.ndarray, label: np.ndarray, new, ratio: float, n_trees: int) -> list[np.ndarray]:
    """Trees grown one after the other on the rows at hand (columns of ``codes``)."""
    width, n = codes.shape
    pieces = [_Piece(np.ascontiguousarray(codes[:, a:a + PIECE_ROWS]), label[a:a + PIECE_ROWS], ratio) for a in range(0, n, PIECE_ROWS)]
    done = []
    for _ in range(n_trees):
        tree = new()
        for piece in pieces:
            piece.start()
        while tree.asked:
            size, place = len(tree.asked) * 256, np.full(len(tree.nodes), -1)
            place[tree.asked] = np.arange(len(tree.asked))
            total = sum((piece.sums(place, size) for piece in pieces), np.zeros((2, width, size)))
            tree.grow(total.reshape(2, width, -1, 256).transpose(2, 1, 3, 0))
            walk = walk_of(tree.nodes)
            for piece in pieces:
                piece.step(walk)
        for piece in pieces:
            piece.margin = piece.margin + tree.nodes["value"][piece.at]
        done.append(tree.nodes)
    return done


def _moved(row: dict, width: int, walks: list[tuple], values: list[np.ndarray]) -> bytes:
    codes, _, margin = _unpacked(row, width)
    return np.stack([m + v[grown(w, codes)] for m, w, v in zip(margin, walks, values)]).tobytes()


def _advanced(blocks: RDD, width: int, trees: list[np.ndarray]) -> RDD:
    """The blocks with every model's tree added to its margins; they are made by the next job and then stay on the executors."""

    def run(rows) -> Iterator[dict]:
        walks, values = [walk_of(tree) for tree in trees], [tree["value"] for tree in trees]
        for row in rows:
            yield {**row, "margin": _moved(row, width, walks, values)}

    return blocks.mapPartitions(run, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
