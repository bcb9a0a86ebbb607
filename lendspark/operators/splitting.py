"""Exact, reproducible splits, folds and samples ordered by a seeded hash of the row id."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .ordering import HashCut, hash_cuts, hash_key, hash_prefix_counts, not_after, stratum_sizes


@dataclass(frozen=True)
class PartitionSpec:
    """Named consecutive parts of each stratum in hash order: ``cuts[stratum][i]`` ends part ``i``."""

    id_col: str
    seed: int
    strata: str | None
    parts: list[str]
    cuts: dict[object, list[HashCut | None]]
    sizes: dict[object, list[int]]

    def part(self, digest: Column | None = None) -> Column:
        """Part name of a row: one projection, no shuffle.  ``digest`` is its hash where that is at hand."""
        h = hash_key(self.id_col, self.seed) if digest is None else digest
        branches = []
        for value, cuts in self.cuts.items():
            expr = F.lit(self.parts[-1])
            for name, cut in list(zip(self.parts[:-1], cuts, strict=False))[::-1]:
                if cut is not None:
                    expr = F.when(not_after(h, self.id_col, cut), name).otherwise(expr)
            here = F.lit(True) if self.strata is None else F.col(self.strata).eqNullSafe(F.lit(value))
            branches.append((here, expr))
        out = F.when(*branches[0])
        for cond, expr in branches[1:]:
            out = out.when(cond, expr)
        return out

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        hashed = df.withColumn("_digest", hash_key(self.id_col, self.seed))  # hashed once per row, compared several times
        return hashed.withColumn(out, self.part(F.col("_digest"))).drop("_digest")


def _fit_parts(df: DataFrame, id_col: str, strata: str | None, seed: int, names: list[str], sizer) -> PartitionSpec:
    counts = hash_prefix_counts(df, id_col, seed, strata)
    sizes = {s: sizer(n) for s, n in stratum_sizes(counts).items()}
    ranks = {s: [sum(parts[: i + 1]) for i in range(len(names) - 1)] for s, parts in sizes.items()}
    return PartitionSpec(id_col, seed, strata, names, hash_cuts(df, id_col, seed, ranks, strata, counts), sizes)


def fit_stratified_split(
    df: DataFrame,
    id_col: str = K.ID,
    strata: str | None = K.TARGET,
    fractions: dict[str, float] | None = None,
    seed: int = K.SEED,
) -> PartitionSpec:
    """Train / val / test in fixed fractions inside every stratum; each row is in exactly one part."""
    fractions = fractions or K.SPLIT_FRACTIONS
    if any(f < 0 for f in fractions.values()) or abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError(f"fractions must be non-negative and sum to 1, got {fractions}")
    names = list(fractions)

    def sizer(n: int) -> list[int]:
        ends, acc = [], 0.0
        for name in names[:-1]:
            acc += fractions[name]
            ends.append(int(acc * n + 1e-9))
        ends.append(n)
        return [b - a for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    return _fit_parts(df, id_col, strata, seed, names, sizer)


def fit_stratified_kfold(
    df: DataFrame, k: int = 5, id_col: str = K.ID, strata: str | None = K.TARGET, seed: int = K.SEED
) -> PartitionSpec:
    """``k`` folds whose sizes differ by at most one inside every stratum."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return _fit_parts(
        df, id_col, strata, seed, [str(i) for i in range(k)],
        lambda n: [n // k + (1 if i < n % k else 0) for i in range(k)],
    )


def sample_rows(df: DataFrame, n: int, id_col: str = K.ID, seed: int = K.SEED) -> DataFrame:
    """Exactly ``n`` rows, uniformly by seeded hash; a filter on the data, not a sort of it."""
    counts = hash_prefix_counts(df, id_col, seed, None)
    if n >= sum(stratum_sizes(counts).values()):
        return df
    cut = hash_cuts(df, id_col, seed, {0: [n]}, None, counts)[0][0]
    return df.where(not_after(hash_key(id_col, seed), id_col, cut)) if cut else df.limit(0)


def split_membership(df: DataFrame, spec: PartitionSpec, id_col: str = K.ID, target: str = K.TARGET) -> DataFrame:
    """The membership table (id, split, target) that replaces positional masks."""
    return spec.transform(df.select(id_col, target), K.SPLIT).select(id_col, K.SPLIT, target)


def only(df: DataFrame, *splits: str) -> DataFrame:
    """Rows of the named splits; prunes partitions when the table is partitioned by split."""
    missing = set(splits) - set(K.SPLITS)
    if missing:
        raise ValueError(f"unknown split {sorted(missing)}")
    return df.where(reduce(lambda a, b: a | b, [F.col(K.SPLIT) == s for s in splits]))
