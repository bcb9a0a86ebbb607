"""Default rates by segment with confidence intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .binning import employment_bucket, income_band
from .guards import require_columns


def _ci(n: Column, rate: Column, z: float) -> Column:
    return F.lit(z) * F.sqrt(rate * (1 - rate) / n)


def rate_by(
    df: DataFrame, keys: Sequence[str], target: str = K.TARGET, z: float = K.Z_ROUNDED, clipped: bool = True,
    min_n: int = 0,
) -> DataFrame:
    """n, default rate and interval per key; partial aggregation makes a hot segment one row per task."""
    agg = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("defaults"))
    rate = F.col("defaults") / F.col("n")
    half = _ci(F.col("n"), F.col("default_rate"), z)
    lo, hi = F.col("default_rate") - half, F.col("default_rate") + half
    if clipped:
        lo, hi = F.greatest(lo, F.lit(0.0)), F.least(hi, F.lit(1.0))
    return agg.where(F.col("n") >= min_n).withColumn("default_rate", rate).select(
        *keys, "n", "default_rate", lo.alias("ci_lo"), hi.alias("ci_hi")
    )


def default_rate_by_segment(
    df: DataFrame, segment: Column | str, target: str = K.TARGET, min_n: int = 100, include_null: bool = True
) -> DataFrame:
    """(segment, n, default_rate, ci_lo, ci_hi), riskiest first.  Missing segments form the NULL group."""
    require_columns(df, [target])
    seg = F.col(segment) if isinstance(segment, str) else segment
    rows = df.select(seg.cast("string").alias("segment"), target)
    if not include_null:
        rows = rows.where("segment IS NOT NULL")
    return rate_by(rows, ["segment"], target, min_n=min_n).orderBy(F.desc("default_rate"), "segment")


def segment_column(dimension: str) -> Column:
    """Segment expression of one of the nine dimensions."""
    if dimension not in K.SEGMENT_DIMENSIONS:
        raise ValueError(f"unknown dimension {dimension!r}; one of {list(K.SEGMENT_DIMENSIONS)}")
    source = K.SEGMENT_DIMENSIONS[dimension]
    if source == "AMT_INCOME_TOTAL":
        return income_band(source)
    if source == "DAYS_EMPLOYED":
        return employment_bucket(source)
    return F.col(source).cast("string")


def segments_all_dimensions(
    df: DataFrame, dimensions: Sequence[str] | None = None, target: str = K.TARGET, min_n: int = 100
) -> DataFrame:
    """All dimensions in one pass: (dimension, segment, n, default_rate, ci_lo, ci_hi)."""
    dims = list(dimensions or K.SEGMENT_DIMENSIONS)
    wide = df.select(target, *[segment_column(d).alias(f"d{i}") for i, d in enumerate(dims)])
    long = wide.unpivot(target, [f"d{i}" for i in range(len(dims))], "d", "segment")
    names = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(dims) for x in (f"d{i}", d)]), F.col("d"))
    # group on the short code, name it afterwards
    return rate_by(long, ["d", "segment"], target, min_n=min_n).select(
        names.alias("dimension"), "segment", "n", "default_rate", "ci_lo", "ci_hi"
    )


def member_filter(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``col`` is among ``values``: a short list, or a frame of any length whose first column is joined."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias("_v")), F.col(col) == F.col("_v"), "left_semi")
    return df.where(F.col(col).isin(list(values)))


def region_filter(df: DataFrame, ratings: Sequence[int], col: str = "REGION_RATING_CLIENT") -> DataFrame:
    return member_filter(df, col, ratings)


def segment_export(segments: DataFrame) -> DataFrame:
    """Names of the downloadable table."""
    return segments.withColumnsRenamed({
        "segment": "Segment", "n": "Applicants", "default_rate": "Default rate", "ci_lo": "95% CI low",
        "ci_hi": "95% CI high",
    })


def top_risk(rates: DataFrame, n: int, key: str) -> DataFrame:
    return rates.orderBy(F.desc("default_rate"), key).limit(n)


def portfolio_kpis(df: DataFrame, score: str | None = None, target: str = K.TARGET) -> DataFrame:
    """n, defaults, default rate, repaid share, and the mean score where there is one."""
    n, bad = F.count("*"), F.sum(F.col(target).cast("long"))
    out = [n.alias("n"), bad.alias("defaults"), (bad / n).alias("default_rate"), (1 - bad / n).alias("repaid_share")]
    if score:
        out.append(F.avg(score).alias("mean_score"))
    return df.agg(*out)


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"), F.avg(value).alias("mean_value"))
