"""Column profiles: one aggregate pass over the table, then reshaping of one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from .guards import numeric_columns
from .quantiles import exact_quantiles

_FAMILIES = {
    "int": ("tinyint", "smallint", "int", "bigint"),
    "float": ("float", "double", "decimal"),
    "object": ("string",),
    "bool": ("boolean",),
}


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_frac) for every column, from one scan."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in cols])
    return one.unpivot([], [f"`{c}`" for c in cols], "column", "missing_frac")


def high_missing(df: DataFrame, threshold: float = K.DROP_MISSING_ABOVE, cols: Sequence[str] | None = None) -> DataFrame:
    return missing_profile(df, cols).where(F.col("missing_frac") > threshold)


def missing_top_k(df: DataFrame, k: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """The k most incomplete columns, ranked from 1 (ties by name).  The ranked table has one row per column."""
    rank = F.row_number().over(Window.orderBy(F.desc("missing_frac"), "column"))
    return missing_profile(df, cols).withColumn("rank", rank).where(F.col("rank") <= k)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n_null, null_share)"""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return one.unpivot("_n", [f"`{c}`" for c in cols], "column", "n_null").select(
        "column", "n_null", (F.col("n_null") / F.col("_n")).alias("null_share")
    )


def dtype_families(df: DataFrame) -> DataFrame:
    """Number of columns per type family; reads the schema only."""
    fams: dict[str, int] = {}
    for _, t in df.dtypes:
        fam = next((f for f, ts in _FAMILIES.items() if t.startswith(ts)), "other")
        fams[fam] = fams.get(fam, 0) + 1
    return df.sparkSession.createDataFrame(sorted(fams.items()), "family string, n_columns int")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def class_balance(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Count and share per class."""
    counts = value_counts(df, target)
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def split_rates(df: DataFrame, split: str = K.SPLIT, target: str = K.TARGET) -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"), F.avg(target).alias("positive_rate"))


def cardinality(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column, n_distinct), a NULL counting as one value.

    Exact: distinct (column, value) pairs are formed map-side first, so a hot value costs one row per task.
    """
    if approximate:
        one = df.agg(*[
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("long"))).alias(c) for c in cols
        ])
        return one.unpivot([], list(cols), "column", "n_distinct")
    return level_counts(df, cols).groupBy("column").agg(F.count("*").alias("n_distinct"))


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, n) over several category columns in one pass."""
    wide = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = wide.unpivot([], [f"`{c}`" for c in cols], "column", "level")
    return long.groupBy("column", "level").agg(F.count("*").alias("n"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def column_summary(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column, median, min, max)"""
    if approximate:
        long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "x")
        return long.groupBy("column").agg(
            F.percentile_approx("x", 0.5, 10_000).alias("median"), F.min("x").alias("min"), F.max("x").alias("max")
        )
    med = exact_quantiles(df, cols, [0.5])
    return describe(df, cols, quartiles={c: [None, m[0], None] for c, m in med.items()}).select(
        F.col("feature").alias("column"), "median", "min", "max"
    )


def describe(df: DataFrame, cols: Sequence[str] | None = None, quartiles: dict | None = None) -> DataFrame:
    """One row per feature: count, mean, std, min, quartiles, max.  Exact quartiles are fitted unless given."""
    cols = list(cols or numeric_columns(df, K.NON_FEATURES))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]) if quartiles is None else quartiles
    long = df.select([F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        [], [f"`{c}`" for c in cols], "feature", "x"
    )
    stats = long.groupBy("feature").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )

    def pick(i: int):
        expr = F.lit(None).cast("double")
        for c in cols:
            if c in q and q[c][i] is not None:
                expr = F.when(F.col("feature") == c, F.lit(float(q[c][i]))).otherwise(expr)
        return expr

    return stats.select(
        "feature", "count", "mean", "std", "min",
        pick(0).alias("p25"), pick(1).alias("median"), pick(2).alias("p75"), "max",
    )


def clean_sanity(cleaned: DataFrame, features: Sequence[str], sentinel: int = K.EMPLOYED_SENTINEL) -> DataFrame:
    """(check, value): nulls left, sentinels left, number of splits, largest absolute train mean."""
    train = F.col(K.SPLIT) == "train"
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cleaned.columns), F.lit(0))
    marks = sum((F.count_if(F.col(f"`{c}`") == sentinel) for c in features), F.lit(0))
    means = F.greatest(*[F.abs(F.avg(F.when(train, F.col(f"`{c}`")))) for c in features], F.lit(0.0))
    one = cleaned.agg(
        nulls.cast("double").alias("nulls_left"), marks.cast("double").alias("sentinels_left"),
        F.count_distinct(K.SPLIT).cast("double").alias("n_splits"), means.alias("max_abs_train_mean"),
    )
    return one.unpivot([], one.columns, "check", "value")
