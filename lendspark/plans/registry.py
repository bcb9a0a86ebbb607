"""Registry of named queries, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .loans import loans_cte

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: dict[str, str] | None = None, book: bool = True):
    """Register a query.  ``sql`` may use ``loans`` (when ``book``) and the named ``ctes``."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            parts = [loans_cte()] if book else []
            parts += [f"{k} AS ({v})" for k, v in (ctes or {}).items()]
            ORACLES[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round the double columns for comparison."""
    out: list[Column] = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        out.append(F.round(col, special.get(c, digits)).alias(c) if t == "double" else col)
    return df.select(*out)
