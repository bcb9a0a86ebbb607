"""Frames of fitted values: a few rows known to the driver, as literals in the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of a small spec.  No Python serialization, one task, and a size the optimizer knows."""
    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    one = spark.range(0, 1, 1, 1)
    if not rows:
        return one.select(*[F.lit(None).cast(t).alias(n) for n, t in fields]).where("1 = 0")
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields, strict=True)]) for r in rows]
    return one.select(F.inline(F.array(*structs)))
