"""Tail probabilities for test statistics.

Spark has no incomplete gamma or beta function.  These Pandas UDFs run on the *result* of a test: one row per feature or
per category column, never on the data itself.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300


def _lentz(step, first: float) -> float:
    """Value of a continued fraction given by ``step(i) -> (a_i, b_i)`` (modified Lentz)."""
    f = first or _TINY
    c, d = f, 0.0
    for i in range(1, 500):
        a, b = step(i)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return f


def log_gamma_tail(s: float, x: float) -> float:
    """ln Q(s, x), the regularized upper incomplete gamma function."""
    if x <= 0:
        return 0.0
    head = s * math.log(x) - x - math.lgamma(s)
    if x < s + 1:
        term = total = 1.0 / s
        n = s
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return math.log1p(-min(math.exp(head + math.log(total)), 1 - 1e-16))
    return head - math.log(_lentz(lambda i: (-i * (i - s), x + 2 * i + 1 - s), x + 1 - s))


def log_beta_cdf(a: float, b: float, x: float) -> float:
    """ln I_x(a, b), the regularized incomplete beta function."""
    if x <= 0:
        return -math.inf
    if x >= 1:
        return 0.0
    if x > (a + 1) / (a + b + 2):
        return math.log1p(-math.exp(log_beta_cdf(b, a, 1 - x)))

    def step(i: int) -> tuple[float, float]:
        m = i // 2
        if i % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    head = a * math.log(x) + b * math.log1p(-x) - math.log(a)
    head -= math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    return head - math.log(_lentz(step, 1.0))


@F.pandas_udf(T.DoubleType())
def _chi2_log10(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(s) or pd.isna(k) or k < 1 else log_gamma_tail(k / 2, s / 2) / math.log(10)
        for s, k in zip(stat, dof, strict=True)
    ], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_log10(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(s) or pd.isna(k) or k < 1 else log_beta_cdf(k / 2, 0.5, k / (k + s * s)) / math.log(10)
        for s, k in zip(t, dof, strict=True)
    ], dtype="float64")


def chi2_log10_p(stat: Column, dof: Column) -> Column:
    """log10 of the upper tail of chi-square; the log form keeps values far below 1e-308."""
    return _chi2_log10(stat.cast("double"), dof.cast("double"))


def t_log10_p(t: Column, dof: Column) -> Column:
    """log10 of the two-sided tail of Student's t."""
    return _t_log10(t.cast("double"), dof.cast("double"))
