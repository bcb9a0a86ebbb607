"""Binning expressions over fixed or fitted edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _edges(edges: Sequence[float] | Column) -> Column:
    return edges if isinstance(edges, Column) else F.array(*[F.lit(float(e)) for e in edges])


_CHAIN = 33


def _chain(x: Column, edges: list[float], closed: str, include_end: bool) -> Column:
    """The same as comparisons in generated code, for a short list of known edges."""
    outside = (x < edges[0]) | (x > edges[-1])
    if not include_end:
        outside = outside | (x == (edges[0] if closed == "right" else edges[-1]))
    out = F.when(outside, F.lit(None).cast("int"))
    for i, hi in enumerate(edges[1:]):
        last = i == len(edges) - 2
        out = out.when(x <= hi if closed == "right" or last else x < hi, i)
    return out


def bin_index(
    x: Column, edges: Sequence[float] | Column, closed: str = "right", include_end: bool = True
) -> Column:
    """0-based bin of ``x``; NULL outside the edges.

    ``closed="right"`` is ``(lo, hi]`` and ``include_end`` adds the lowest edge to the first bin; ``closed="left"`` is
    ``[lo, hi)`` with the highest edge in the last bin.  ``edges`` is a list or, for fitted per-group bins, an array
    column.
    """
    if not isinstance(edges, Column) and 2 <= len(edges) <= _CHAIN:
        return _chain(x, [float(e) for e in edges], closed, include_end)
    e = _edges(edges)
    last = F.size(e) - 1
    inside = (x >= F.element_at(e, 1)) & (x <= F.element_at(e, -1))
    if closed == "right":
        passed = F.size(F.filter(e, lambda b: b < x)) - 1
        idx = F.greatest(passed, F.lit(0)) if include_end else F.when(passed >= 0, passed)
    else:
        passed = F.size(F.filter(e, lambda b: b <= x)) - 1
        idx = F.least(passed, last - 1) if include_end else F.when(passed < last, passed)
    return F.when(inside & (last > 0), idx)


def bin_label(idx: Column, labels: Sequence[str]) -> Column:
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in labels]), idx + 1))


def bin_midpoint(idx: Column, edges: Sequence[float] | Column) -> Column:
    e = _edges(edges)
    return F.when(idx.isNotNull(), (F.element_at(e, idx + 1) + F.element_at(e, idx + 2)) / 2)
