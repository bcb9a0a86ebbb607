"""Checks that fail early, on the schema where possible."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_dataframe(df: object) -> DataFrame:
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    return df


def expect_shape(df: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """Raise unless the frame has the agreed shape (the contract is a parameter)."""
    if cols is not None and len(df.columns) != cols:
        raise ValueError(f"expected {cols} columns, got {len(df.columns)}")
    if rows is not None and (n := df.count()) != rows:
        raise ValueError(f"expected {rows} rows, got {n}")
    return df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c, t in df.dtypes if t in NUMERIC and c not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c, t in df.dtypes if t == "string" and c not in skip]


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column, so that averages, medians and joins treat missing alike."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df
