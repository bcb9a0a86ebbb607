"""Audits of raw files and id ranges."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import SINGLE_TASK_ROWS, range_bucket
from ..session import materialize

_ID_BLOCK = 1 << 20


def line_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, lines, quotes, even, blank_even, blank_odd): each block of each file, counted where it is read.

    ``even``: lines after which the block has had an even number of quotes; of the blank lines those in either state.  A block is what one
    scan task reads of a file, so a large file is counted by many tasks.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[int]] = {}
        for batch in batches:
            value, file, start = batch.columns
            quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
            blank = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(value)), 0).to_numpy(zero_copy_only=False)
            # runs of one block; a task reads its blocks one after the other
            places = list(zip(file.to_pylist(), start.to_pylist()))
            cuts = [0, *(k for k in range(1, len(places)) if places[k] != places[k - 1]), len(places)]
            for a, b in zip(cuts, cuts[1:]):
                own = found.setdefault(places[a], [0] * 5)
                odd = (own[1] + np.cumsum(quotes[a:b])) % 2 == 1
                for k, n in enumerate((b - a, int(quotes[a:b].sum()), int((~odd).sum()), int((blank[a:b] & ~odd).sum()), int((blank[a:b] & odd).sum()))):
                    own[k] += n
        yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK.names, (*k, *v))) for k, v in found.items()], schema=_BLOCK)

    return lines.mapInArrow(count, "file string, start long, lines long, quotes long, even long, blank_even long, blank_odd long")


_BLOCK = pa.schema([("file", pa.string()), *((n, pa.int64()) for n in ("start", "lines", "quotes", "even", "blank_even", "blank_odd"))])


def line_audit(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(physical_lines, parsed_rows) of a CSV file or folder with headers: they differ when records hold line breaks.

    A record ends with the line after which the file has had an even number of quotes.  Blocks are counted for either state; the quotes of
    the blocks before, a running sum over one row a block, say which state it was.  Blank records don't count.  Without
    ``multi_line`` every line is a record.
    """
    blocks = line_blocks(spark, path)
    before = F.coalesce(F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    records = F.when(F.col("odd") == 0, F.col("even") - F.col("blank_even")).otherwise(F.col("lines") - F.col("even") - F.col("blank_odd"))
    if not multi_line:
        records = F.col("lines") - F.col("blank_even") - F.col("blank_odd")
    files = blocks.withColumn("odd", before).groupBy("file").agg(F.sum("lines").alias("lines"), F.sum(records).alias("records"))
    return files.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("physical_lines"), F.coalesce(F.sum(F.greatest(F.col("records") - 1, F.lit(0))), F.lit(0)).alias("parsed_rows"))


def embedded_newlines(df: DataFrame, *cols: str) -> DataFrame:
    """Rows, rows with a line break in any of the string columns, and the number of line breaks."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit("\n")), F.lit(False)) for c in cols])
    breaks = reduce(lambda a, b: a + b, [_occurrences(c, "\n") for c in cols])
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(hit).alias("n_embedded"), F.sum(breaks).cast("long").alias("n_newlines")
    )


def _occurrences(col: str, char: str):
    c = F.coalesce(F.col(col), F.lit(""))
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def records_with_newline(df: DataFrame, *cols: str) -> DataFrame:
    hit = reduce(lambda a, b: a | b, [F.contains(F.col(c), F.lit("\n")) for c in cols])
    return df.where(hit)


def ragged_records(spark: SparkSession, path: str, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """Raw records whose number of fields differs from the header: (record); the first ``k`` as a report, or all."""
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _corrupt_record string"
    lines = spark.read.text(path).where(F.col("value") != ",".join(columns))
    parsed = F.from_csv("value", schema, {"mode": "PERMISSIVE", "escape": '"'})
    bad = lines.where(parsed["_corrupt_record"].isNotNull()).select(F.col("value").alias("record"))
    return bad.limit(k) if k else bad


def quote_parity(df: DataFrame, col: str) -> DataFrame:
    """Number of double quotes, its parity, and rows with an odd number."""
    q = _occurrences(col, '"')
    total = F.sum(q).cast("long")
    return df.agg(
        total.alias("n_quotes"), (total % 2).alias("parity"), F.count_if(q % 2 == 1).alias("n_odd_rows")
    )


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, md5) of each file; a whole file is one binary value, so this is for files below 2 GB."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.md5("content").alias("md5"))


def check_fingerprint(spark: SparkSession, path: str, length: int, md5: str) -> None:
    got = file_fingerprint(spark, path).first()
    if (got.length, got.md5) != (length, md5):
        raise ValueError(f"{path}: expected {length} bytes with md5 {md5}, got {got.length} with {got.md5}")


def _between(ends: DataFrame, bucket_rows: int) -> DataFrame:
    """(id, next_id) from each block's last id to the next block's first."""
    step = lambda w: F.lead("lo").over(w).alias("next_id")
    ends = materialize(ends)
    bucketed = range_bucket(ends.withColumn("at", F.col("block").cast("double")), "at", single_task_rows=bucket_rows)
    if bucketed is None:
        return ends.select(F.col("hi").alias("id"), step(Window.partitionBy(F.lit(0)).orderBy("block")))
    inside = bucketed.select(F.col("hi").alias("id"), step(Window.partitionBy("_bucket").orderBy("block")))
    last = bucketed.groupBy("_bucket").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return inside.unionByName(last.select(F.col("hi").alias("id"), step(Window.partitionBy(F.lit(0)).orderBy("_bucket"))))


def id_gaps(df: DataFrame, id_col: str, bucket_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """(id, next_id, n_missing) where sorted ids jump.

    Distinct ids fall into blocks of 2^20 consecutive values, so no window holds more than 2^20 rows.  Block ends (one row per
    block; for scattered ids that is one per id) are linked inside range buckets, and only bucket ends meet in one window.
    """
    ids = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    ids = ids.withColumn("block", F.floor(F.col("id") / _ID_BLOCK))
    inner = ids.withColumn("next_id", F.lead("id").over(Window.partitionBy("block").orderBy("id"))).select("id", "next_id")
    ends = ids.groupBy("block").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    return inner.unionByName(_between(ends, bucket_rows)).where(F.col("next_id") - F.col("id") > 1).withColumn(
        "n_missing", F.col("next_id") - F.col("id") - 1
    )


def missing_ranges(df: DataFrame, id_col: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """(first, last, n_missing): runs of ids of the range that do not occur; as many rows as there are gaps, however wide.

    ``lo`` and ``hi`` default to the smallest and largest id.  Without ids, and without a range, there are no rows.
    """
    spark = df.sparkSession
    ids = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    if lo is not None:
        ids = ids.where(F.col("id") >= lo)
    if hi is not None:
        ids = ids.where(F.col("id") <= hi)
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    schema = "first long, last long"
    if ends.lo is None:
        edges = [(lo, hi)] if lo is not None and hi is not None and lo <= hi else []
        out = spark.createDataFrame(edges, schema)
    else:
        edges = [(lo, ends.lo - 1)] if lo is not None and lo < ends.lo else []
        edges += [(ends.hi + 1, hi)] if hi is not None and ends.hi < hi else []
        inner = id_gaps(ids, "id").select((F.col("id") + 1).alias("first"), (F.col("next_id") - 1).alias("last"))
        out = inner.unionByName(spark.createDataFrame(edges, schema))
    return out.withColumn("n_missing", F.col("last") - F.col("first") + 1)


def missing_ids(df: DataFrame, id_col: str, lo: int | None = None, hi: int | None = None, at_most: int = 10_000_000_000) -> DataFrame:
    """Ids of the full range that do not occur, one row each.  More than ``at_most`` of them raise: ``missing_ranges`` lists any number."""
    ranges = materialize(missing_ranges(df, id_col, lo, hi))
    total = ranges.agg(F.sum(F.col("n_missing").cast("decimal(38,0)"))).first()[0] or 0
    if total > at_most:
        raise ValueError(f"{total} ids are missing; missing_ranges lists them as ranges")
    # wide gaps are cut first, so that no array is long
    parts = ranges.select("last", F.explode(F.sequence("first", "last", F.lit(_ID_BLOCK))).alias("at"))
    return parts.select(F.explode(F.sequence("at", F.least(F.col("at") + _ID_BLOCK - 1, F.col("last")))).alias("id"))


