"""The seven engineered columns.  Unit-agnostic, but meant for raw units: apply before scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import row_mean, safe_divide, years_from_days
from .guards import require_columns

REQUIRED = [
    "DAYS_BIRTH", "DAYS_EMPLOYED", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "AMT_GOODS_PRICE",
    "CNT_FAM_MEMBERS", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
]


def engineer_features(df: DataFrame) -> DataFrame:
    require_columns(df, REQUIRED)
    return df.withColumns({
        "AGE_YEARS": years_from_days("DAYS_BIRTH"),
        "EMPLOYED_YEARS": years_from_days("DAYS_EMPLOYED"),
        "CREDIT_INCOME_RATIO": safe_divide("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "ANNUITY_INCOME_RATIO": safe_divide("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "CREDIT_GOODS_RATIO": safe_divide("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "INCOME_PER_FAM_MEMBER": safe_divide("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "EXT_SOURCE_MEAN": row_mean("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"),
    })


def credit_to_income(df: DataFrame, out: str = "CTI") -> DataFrame:
    """Ratio with only a zero income as missing (a negative income keeps its sign, unlike the safe ratio)."""
    return df.withColumn(out, F.col("AMT_CREDIT") / F.nullif(F.col("AMT_INCOME_TOTAL"), F.lit(0.0)))


def standardized(df: DataFrame, col: str, out: str) -> DataFrame:
    """Z-score with the sample deviation, and its square, over the whole table."""
    s = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).first()
    z = (F.col(col) - F.lit(s.m)) / F.nullif(F.lit(s.s), F.lit(0.0))
    return df.withColumns({out: z, f"{out}2": z * z})
