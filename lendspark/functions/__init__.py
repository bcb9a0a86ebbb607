"""Column expressions: everything here stays inside the JVM unless it says otherwise."""

from .bins import bin_index, bin_label, bin_midpoint
from .scalars import (
    clip,
    drift_verdict,
    feature_family,
    map_values,
    nan_to_null,
    policy_band,
    row_mean,
    safe_divide,
    sentinel_to_null,
    sigmoid,
    years_from_days,
)

__all__ = [
    "bin_index",
    "bin_label",
    "bin_midpoint",
    "clip",
    "drift_verdict",
    "feature_family",
    "map_values",
    "nan_to_null",
    "policy_band",
    "row_mean",
    "safe_divide",
    "sentinel_to_null",
    "sigmoid",
    "years_from_days",
]
