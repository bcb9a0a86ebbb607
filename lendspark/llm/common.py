"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize


#: written to the shared folder and read back: one copy that every executor reaches, so lost executors recompute nothing before it
save = materialize


def drop(df: DataFrame) -> None:
    """Delete the files of a saved frame that nothing will read again."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        where = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def empty_text(text: str = "text"):
    """The text, with null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def map_texts(df: DataFrame, text: str, fields: str, make: Callable[[], Callable[..., list[list]]], part_bytes: int = 2_000_000,
              also: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``df`` with new columns (``fields``, as DDL) computed from its text, in Arrow batches, without a shuffle.

    ``make`` runs once a task and gives the function from a list of texts (None for null), and of the columns ``also``, to the lists of new values.  It gets a few
    megabytes of text at a time, so memory doesn't follow the batch size.  Columns of ``df`` with the new names are replaced.
    """
    new = T._parse_datatype_string(fields).fields
    names = {f.name for f in new}
    if text in names:
        raise ValueError(f"column {text!r} is the input")
    df = df.drop(*names).withColumn(text, F.col(f"`{text}`").cast("string"))
    kinds = [to_arrow_type(f.dataType) for f in new]
    labels = [*df.columns, *(f.name for f in new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            start = 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + part_bytes, side="right")))
                part = batch.slice(start, stop - start)
                values = own(part.column(at).to_pylist(), *(part.column(labels.index(c)).to_pylist() for c in also))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(v, type=k) for v, k in zip(values, kinds))], names=labels)
                start = stop

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *new]))


def bounded_sample(df: DataFrame, group: str, key: str | list[str], bound: int) -> DataFrame:
    """About ``bound`` rows of each group, the same in every run: those whose hashed ``key`` columns lie below the group's share.

    Rows that agree in group and key are one row.  The share aims at 95 % of the bound, which chance then hardly passes; groups within
    the bound are whole.  A null in a key is a value like others, so name columns that tell rows apart even where an id is null.  One
    count per group (a label or language, so few), no sort, and no group meets in a task.
    """
    keys = [key] if isinstance(key, str) else key
    h = F.xxhash64(*keys, F.lit(17))
    place = F.pmod(h, F.lit(1 << 52))
    keep = F.lit(False)
    for g, n in df.groupBy(F.col(group).alias("g")).agg(F.count_distinct(h)).collect():
        own = F.col(group).eqNullSafe(F.lit(g))
        keep = keep | (own if n <= bound else own & (place < int(0.95 * bound / n * (1 << 52))))
    return df.where(keep).dropDuplicates([group, *keys])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit counter-based generator: well mixed, the same everywhere."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def components(spark: SparkSession, edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component) with the smallest node reachable over ``edges`` (a, b); nodes without edges are absent.

    Alternating large-star and small-star rounds: O(log n) rounds of grouped minima and joins on the node, each cut by a written
    table.  A hub is only ever summed (map-side minimum) or joined (split by adaptive skew handling), never collected.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = save(e)
    before = None
    for _ in range(limit):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # now every pair points down: group by the larger end, link all smaller ends and it to their minimum
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct("u", F.col("m").alias("v")))).alias("x"))
                 .select("x.*").where("u <> v").distinct())
        new = save(small)
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(e)
        e = new
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the links (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


class Remembered(dict):
    """What ``make`` gave for recent keys.  Two generations of ``limit`` entries bound the memory and keep what is in use."""

    def __init__(self, make, limit: int = 250_000, longest: int = 64) -> None:
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def put(self, key: str, value) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self.put(key, value)
        return value
