"""Global running sums and exact hash-ordered cuts, without a single-task sort of the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .small import literal_frame

SINGLE_TASK_ROWS = 1_000_000
MAX_BUCKETS = 1024


def range_bucket(
    df: DataFrame, col: str, out: str = "_bucket", single_task_rows: int = SINGLE_TASK_ROWS
) -> DataFrame | None:
    """Add an order-preserving bucket of ``col`` so that no bucket holds much more than ``single_task_rows``.

    None when the whole frame fits one task.

    The splitters come from a fixed-size sketch (at most 1,024 numbers) and are literals in the plan, so every
    re-computation of the frame buckets alike; ``repartitionByRange`` samples anew and does not.
    """
    probe = df.agg(
        F.count(col).alias("n"),
        F.percentile_approx(col, F.array(*[F.lit(i / MAX_BUCKETS) for i in range(1, MAX_BUCKETS)]), 10_000).alias("g"),
    ).first()
    parts = min(MAX_BUCKETS, -(-probe.n // single_task_rows))
    if parts <= 1:
        return None
    inner = sorted({probe.g[i * MAX_BUCKETS // parts - 1] for i in range(1, parts)})
    splits = [float("-inf"), *inner, float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on group columns in which NULL is a group like any other."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(named[f"_r_{c}"]) for c in by])
    return left.join(named, same).drop(*[f"_r_{c}" for c in by])


def running_sums(
    df: DataFrame,
    order_col: str,
    sums: dict[str, str],
    by: Sequence[str] = (),
    descending: bool = True,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Running total of each ``sums[new] = column`` along ``order_col`` within ``by``, in two levels.

    ``df`` holds one row per (by, order value), pre-aggregated.  Rows are summed inside range buckets; bucket totals (at
    most 1,024 per group) are prefix-summed and joined back as offsets.  No task ever sees a whole group.
    """
    by = list(by)
    col_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    bucketed = range_bucket(df, order_col, "_bucket", single_task_rows)
    if bucketed is None:
        whole = Window.partitionBy(*by).orderBy(col_order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({new: F.sum(c).over(whole) for new, c in sums.items()})
    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    key = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in sums]
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(col_order).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_groups(bucketed, offsets, [*by, "_bucket"])
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(c).over(inside) + F.col(f"_o_{new}")).alias(new) for new, c in sums.items()],
    )


# ---------------------------------------------------------------------------------------------------------------------
# hash-ordered cuts
# ---------------------------------------------------------------------------------------------------------------------

_DIGITS = 3


@dataclass(frozen=True)
class HashCut:
    """The ``count``-th smallest (hash, id) of a stratum; rows up to it belong to the part."""

    digest: str
    id: int


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def not_after(h: Column, id_col: str, cut: HashCut) -> Column:
    return (h < cut.digest) | ((h == cut.digest) & (F.col(id_col) <= cut.id))


def hash_prefix_counts(df: DataFrame, id_col: str, seed: int, strata: str | None) -> DataFrame:
    """(s, p, n): rows per stratum and first three hex digits, as a written table of at most 4,096 rows a stratum."""
    keyed = _keyed(df, id_col, seed, strata)
    return materialize(keyed.groupBy("s", F.substring("h", 1, _DIGITS).alias("p")).agg(F.count("*").alias("n")))


def stratum_sizes(counts: DataFrame) -> dict:
    """Rows per stratum; the spec that is fitted holds a few numbers for each as well."""
    return {r.s: r.n for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect()}


def _located(counts: DataFrame, ranks: dict[object, list[int]]) -> dict[tuple, tuple[str, int, int]]:
    """(stratum, rank) -> (prefix that holds it, rank inside the prefix, rows under it), found by running sums in Spark."""
    kind = dict(counts.dtypes)["s"]
    wanted = literal_frame(counts.sparkSession, [(s, r) for s, rs in ranks.items() for r in sorted(set(rs)) if r > 0], f"t {kind}, want long")
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumn("upto", upto).join(wanted, F.col("s").eqNullSafe(F.col("t")))
    rows = rows.where("want <= upto and want > upto - n")
    return {(r.s, r.want): (r.p, r.want - r.upto + r.n, r.n) for r in rows.collect()}


def _keyed(df: DataFrame, id_col: str, seed: int, strata: str | None) -> DataFrame:
    label = F.col(strata) if strata else F.lit(0)
    return df.select(label.alias("s"), hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))


def hash_cuts(
    df: DataFrame, id_col: str, seed: int, ranks: dict[object, list[int]], strata: str | None,
    counts: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS,
) -> dict[object, list[HashCut | None]]:
    """For each stratum, the rows at the given 1-based ranks in (md5, id) order; rank 0 gives None.

    md5 digests are uniform, so ``counts`` (rows per hex prefix) tell which prefix holds a rank.  Only rows under that
    prefix (1 in 4,096 per level) are looked at again.  Transforming with the cuts is then a plain projection: the data
    is neither sorted nor shuffled.
    """
    keyed = _keyed(df, id_col, seed, strata)
    # (stratum, rank) -> (prefix, rank inside the prefix, rows under it)
    located = _located(counts, ranks)
    while True:
        depth = min((len(p) for p, _, n in located.values() if n > single_task_rows), default=0)
        deep = {k: v for k, v in located.items() if v[2] > single_task_rows and len(v[0]) == depth}
        if not deep:
            break
        heads = list({p for p, _, _ in deep.values()})
        rows = keyed.where(F.substring("h", 1, depth).isin(heads))
        finer = rows.groupBy("s", F.substring("h", 1, depth + _DIGITS).alias("p")).agg(F.count("*").alias("n"))
        below = {(r.s, r.p): r.n for r in finer.collect()}
        located |= {k: _locate(below, k[0], p, want) for k, (p, want, _) in deep.items()}
    if not located:
        return {s: [None] * len(rs) for s, rs in ranks.items()}
    prefixes = {p for p, _, _ in located.values()}
    by_len = {n: [p for p in prefixes if len(p) == n] for n in {len(p) for p in prefixes}}
    under = reduce(lambda a, b: a | b, [F.substring("h", 1, n).isin(ps) for n, ps in by_len.items()])
    head = F.coalesce(*[F.when(F.substring("h", 1, n).isin(ps), F.substring("h", 1, n)) for n, ps in sorted(by_len.items())[::-1]])
    rank = F.row_number().over(Window.partitionBy("s", "p").orderBy("h", "id"))
    found = (
        keyed.where(under).withColumn("p", head).withColumn("r", rank)
        .where(F.col("r").isin(list({w for _, w, _ in located.values()}))).collect()
    )
    at = {(f.s, f.p, f.r): HashCut(f.h, f.id) for f in found}
    cuts = {(s, r): at[(s, p, want)] for (s, r), (p, want, _) in located.items()}
    return {s: [cuts.get((s, r)) for r in rs] for s, rs in ranks.items()}


def _locate(counts: dict[tuple, int], stratum, head: str, want: int) -> tuple[str, int, int]:
    """Prefix under ``head`` that holds the ``want``-th row, the rank inside it, and its rows."""
    for p in sorted(p for s, p in counts if s == stratum and p.startswith(head)):
        n = counts[(stratum, p)]
        if want <= n:
            return p, want, n
        want -= n
    raise ValueError(f"stratum {stratum!r} has too few rows")
