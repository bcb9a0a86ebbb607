"""Scalar expressions.  Missing is always SQL NULL; NaN is turned into NULL where data enters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def sentinel_to_null(c: Column | str, sentinel: int = K.EMPLOYED_SENTINEL) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den`` where the denominator is positive, else NULL (ANSI mode would raise on zero)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den)


def years_from_days(days: Column | str) -> Column:
    """Day offsets are stored as negative numbers."""
    return -_col(days) / F.lit(K.DAYS_PER_YEAR)


def row_mean(*cols: Column | str) -> Column:
    """Mean across columns ignoring NULLs; NULL when all are."""
    cs = [_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    known = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return F.when(known > 0, total / known)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]; ``greatest``/``least`` skip NULLs, hence the guard."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def sigmoid(c: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(c)))


def policy_band(p: Column | str, approve_below: float = K.APPROVE_BELOW, reject_from: float = K.REJECT_FROM) -> Column:
    p = _col(p)
    return (
        F.when(p < approve_below, "Approve").when(p >= reject_from, "Reject").when(p.isNotNull(), "Manual Review")
    )


def drift_verdict(psi: Column | str) -> Column:
    psi = _col(psi)
    return (
        F.when(psi < K.PSI_MODERATE_FROM, "no_drift")
        .when(psi < K.PSI_MAJOR_FROM, "moderate_drift")
        .when(psi.isNotNull(), "major_drift")
    )


def feature_family(name: Column | str) -> Column:
    """Family of a feature by its name.  The order matters: the first matching rule wins."""
    n = _col(name)
    rules = [
        (n.startswith("EXT_SOURCE"), "EXT_SOURCE"),
        (n.startswith("DAYS_") | n.isin("AGE_YEARS", "EMPLOYED_YEARS"), "Time-derived"),
        (n.startswith("NAME_") | n.startswith("CODE_") | n.startswith("FLAG_"), "One-hot / flag"),
        (n.contains("RATIO") | n.contains("INCOME"), "Ratio"),
        (n.startswith("AMT_"), "Amount"),
        (n.contains("AREA") | n.contains("LIVING"), "Area"),
    ]
    out = F.when(*rules[0])
    for cond, label in rules[1:]:
        out = out.when(cond, label)
    return out.otherwise("Other")


def map_values(c: Column | str, mapping: dict[str, str]) -> Column:
    """Dictionary lookup; unknown keys give NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c))
