"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

All stages but the last return the columns of ``documents``.  Null texts are rejected by the first stage; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.bpe import encode
from lendspark.llm.common import save
from lendspark.llm.langid import identify, train
from lendspark.llm.linededup import dedup_lines
from lendspark.llm.minhash import drop_near_duplicates
from lendspark.llm.mixing import mixed


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which some learnt language is recognised; without letters or coded worse than by chance they go."""
    return identify(docs, train(docs)).where("not rejected").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that an earlier document has; documents of which nothing is left go."""
    done = dedup_lines(docs).where("n_cut = 0 or text <> ''")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_cut") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents as often as it takes them."""
    return mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix (packed little-endian), with their number and whether they decode to the text."""
    rule = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = encode(docs.select("doc_id", "source", "text"), *rule, decoded="decoded")
    return done.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: language ID, line dedup, near-duplicate groups and encoding are no single SQL statement; tests hold the stages against brute force
ORACLE_SQL = None
