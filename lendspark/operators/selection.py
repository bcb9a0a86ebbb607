"""Feature ranking and selection on importance tables (one row per feature)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import feature_family


def _ranked(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.withColumns({
        rank: F.rank().over(Window.orderBy(F.col(value).desc())) for value, rank in values.items()
    })


def _merge(df: DataFrame, ranks: Sequence[str], n: Column) -> DataFrame:
    k = len(ranks)
    mean = reduce(lambda a, b: a + b, [F.col(r) for r in ranks]) / k
    score = reduce(lambda a, b: a + b, [(n - F.col(r)) / F.nullif(n - 1, F.lit(0)) for r in ranks]) / k
    return df.withColumns({"mean_rank": mean, "combined_score": score})


def rank_merge(importance: DataFrame, first: str = "xgb_importance", second: str = "rf_importance") -> DataFrame:
    """Ranks of two importances, their mean and the score in [0, 1]; best first."""
    n = F.count("*").over(Window.partitionBy())
    ranks = {first: first.replace("importance", "rank"), second: second.replace("importance", "rank")}
    return _merge(_ranked(importance, ranks), list(ranks.values()), n).orderBy("mean_rank", "feature")


def select_top_n(importance: DataFrame, attribution: DataFrame, n: int = 30) -> DataFrame:
    """Three-way mean rank with the mean absolute attribution (feature, shap_mean_abs), top ``n``."""
    shap = _ranked(attribution, {"shap_mean_abs": "shap_rank"})
    joined = importance.join(shap, "feature")  # both sides have one row per feature
    merged = _merge(joined, ["xgb_rank", "rf_rank", "shap_rank"], F.count("*").over(Window.partitionBy()))
    return merged.orderBy("mean_rank", "feature").limit(n)


def numbered(selected: DataFrame) -> DataFrame:
    """Position from 1 in ranking order."""
    return selected.withColumn("position", F.row_number().over(Window.orderBy("mean_rank", "feature")))


def top_k_names(df: DataFrame, value: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(value), "feature").limit(k).select("feature")


def topk_agreement(df: DataFrame, first: str, second: str, k: int = 10) -> DataFrame:
    return top_k_names(df, first, k).intersect(top_k_names(df, second, k))


def topk_disagreement(df: DataFrame, first: str, second: str, k: int = 10) -> DataFrame:
    """(feature, only_in)"""
    a, b = top_k_names(df, first, k), top_k_names(df, second, k)
    return a.exceptAll(b).withColumn("only_in", F.lit(first)).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit(second))
    )


def importance_bar(df: DataFrame, families: Sequence[str] | None = None, k: int = 30) -> DataFrame:
    """Top features with their family, optionally only some families."""
    out = df.withColumn("family", feature_family("feature"))
    if families is not None:
        out = out.where(F.col("family").isin(list(families)))
    return out.orderBy(F.desc("combined_score"), "feature").limit(k)
