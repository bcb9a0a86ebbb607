"""Correlation and independence tests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.distributions import chi2_log10_p, t_log10_p
from .profiling import level_counts


def pearson_target(df: DataFrame, features: Sequence[str], target: str = K.TARGET) -> DataFrame:
    """(feature, n, r, t, log10_p): pairwise-complete Pearson r against the target."""
    wide = df.select(F.col(target).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    rows = wide.unpivot("_y", [f"`{c}`" for c in features], "feature", "x")
    # long form: a handful of aggregates in one generated loop, against hundreds of buffers in wide form
    long = rows.groupBy("feature").agg(
        F.count_if(F.col("x").isNotNull() & F.col("_y").isNotNull()).alias("n"), F.corr("x", "_y").alias("r")
    )
    free = F.col("n") - 2
    t = F.col("r") * F.sqrt(free / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0)))
    long = long.withColumn("t", F.when(free > 0, t))
    return long.withColumn("log10_p", t_log10_p(F.col("t"), F.col("n") - 2))


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Upper triangle (i, j, a, b, n, r) of the pairwise-complete Pearson matrix.

    d^2/2 ``corr`` aggregates would blow past codegen limits, so each task sums cross-products of Arrow batches with one
    matrix product per batch and emits d^2/2 partial sums; Spark adds those per pair.  Values are shifted by the column
    means first, which keeps the sums of squares well conditioned.
    """
    cols = list(features)
    d = len(cols)
    wide = df.select([F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    shift = np.array([m if m is not None else 0.0 for m in wide.agg(*[F.avg(c) for c in wide.columns]).first()])
    upper = np.triu_indices(d, 1)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((6, d, d))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            m = (~np.isnan(x)).astype(float)
            x = np.where(m > 0, x - shift, 0.0)
            sq = x * x
            acc += np.stack([m.T @ m, x.T @ m, m.T @ x, sq.T @ m, m.T @ sq, x.T @ x])
        yield pd.DataFrame({"i": upper[0], "j": upper[1], **{f"s{k}": acc[k][upper] for k in range(6)}})

    schema = "i int, j int, s0 double, s1 double, s2 double, s3 double, s4 double, s5 double"
    sums = wide.mapInPandas(partial, schema).groupBy("i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)])
    n, sx, sy, sxx, syy, sxy = (F.col(f"s{k}") for k in range(6))
    num = n * sxy - sx * sy
    den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        "i", "j", names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), n.cast("long").alias("n"),
        F.when(den > 0, num / den).alias("r"),
    )


def top_correlated(df: DataFrame, features: Sequence[str], k: int = 25, target: str = K.TARGET) -> DataFrame:
    return pearson_target(df, features, target).orderBy(F.abs("r").desc_nulls_last(), "feature").limit(k)


def collinear_pairs(matrix: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Feature pairs with a large absolute correlation; the triangle is part of the matrix rows."""
    return matrix.where(F.abs("r") > threshold).select("a", "b", "r")


def crosstab(df: DataFrame, col: str, target: str = K.TARGET) -> DataFrame:
    """(level, n0, n1)"""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(
        F.count_if(F.col(target) == 0).alias("n0"), F.count_if(F.col(target) == 1).alias("n1")
    )


def chi_square(df: DataFrame, cols: Sequence[str], target: str = K.TARGET) -> DataFrame:
    """Independence of each category column from the binary target, all columns in one pass.

    (feature, n, levels, dof, chi2, log10_p, cramers_v, significant).  With row totals R_i and column totals C_j the
    statistic is n (sum O_ij^2 / (R_i C_j) - 1), a plain aggregate over levels: no expected-count table is built.  With one
    degree of freedom the continuity correction scales it, since all |O - E| are equal in a 2 x 2 table.
    """
    wide = df.where(F.col(target).isin(0, 1)).select(F.col(target).alias("y"), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = wide.unpivot("y", [f"`{c}`" for c in cols], "feature", "level").where("level IS NOT NULL")
    per = long.groupBy("feature", "level").agg(F.count("*").alias("r"), F.sum("y").alias("b"))
    a = (F.col("r") - F.col("b")).cast("double")
    b, r = F.col("b").cast("double"), F.col("r").cast("double")
    s = per.groupBy("feature").agg(
        F.sum("r").alias("n"), F.sum("b").cast("double").alias("c1"), F.count("*").alias("levels"),
        F.sum(a * a / r).alias("s0"), F.sum(b * b / r).alias("s1"), F.sum(1 / r).alias("inv"),
    ).where((F.col("c1") > 0) & (F.col("n") > F.col("c1")))
    c0 = F.col("n") - F.col("c1")
    plain = F.greatest(F.col("n") * (F.col("s0") / c0 + F.col("s1") / F.col("c1") - 1), F.lit(0.0))
    gap = F.sqrt(F.col("plain") / (F.col("n") * F.col("inv") * (1 / c0 + 1 / F.col("c1"))))
    shrunk = F.when(F.col("gap") > 0, F.col("plain") * F.pow((F.col("gap") - F.least(F.col("gap"), F.lit(0.5))) / F.col("gap"), 2))
    s = s.withColumn("plain", plain).withColumn("gap", gap).withColumn("dof", F.col("levels") - 1)
    s = s.withColumn("chi2", F.when(F.col("dof") == 1, F.coalesce(shrunk, F.lit(0.0))).otherwise(F.col("plain")))
    s = s.withColumn("log10_p", chi2_log10_p(F.col("chi2"), F.col("dof")))
    # the target has two classes, so min(rows, columns) - 1 is 1
    return s.select(
        "feature", "n", "levels", "dof", "chi2", "log10_p",
        F.when(F.col("dof") > 0, F.sqrt(F.col("chi2") / F.col("n"))).alias("cramers_v"),
        (F.col("log10_p") < -3).alias("significant"),
    )


def distinct_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return level_counts(df, cols).groupBy("column").agg(F.count("*").alias("n_levels"))


def fold_summary(folds: DataFrame, keys: Sequence[str] = ("feature_set",)) -> DataFrame:
    """Mean and population deviation of the fold AUCs."""
    return folds.groupBy(*keys).agg(
        F.count("*").alias("folds"), F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc")
    )


def carry_forward(summary: DataFrame, small: str, full: str, tolerance: float = 0.01) -> DataFrame:
    """One row: AUC change of the small set against the full one and which set to carry forward."""
    wide = summary.groupBy().pivot("feature_set", [small, full]).agg(F.first("mean_auc"))
    delta = F.col(small) - F.col(full)
    return wide.select(
        F.col(small).alias("auc_small"), F.col(full).alias("auc_full"), delta.alias("delta"),
        F.when(delta > -tolerance, small).otherwise(full).alias("carry_forward"),
    )


def importance_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank, largest first, ties share the smallest rank.  One row per feature, so a global window is bounded."""
    return df.withColumn(out, F.rank().over(Window.orderBy(F.desc(value))))
