"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within cells, one representative a group.

Equal vectors of a label are one class first.  Every class has a home cell, that of its nearest centroid; it also visits each cell in which a
vector close enough could live: if |x - y| <= e for unit vectors and x is nearer to centroid c than to any other, then
y . (c' - c) <= e |c' - c| for every c'.  Home classes of a cell are compared with its visitors, in blocks of bounded size, so
every pair of a label is compared in both of its homes and no link is missed.  A block gives one number a class and a spanning
forest of its links, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import fit, unit, usable
from .common import components, forest, save

BLOCK = 1024  # classes on either side of a product
PER_CELL = 2000  # classes a cell is meant for


def near_vectors(df: DataFrame, similarity: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector: key, n_links (other vectors linked directly), component_id (smallest key reachable), kept (key = component_id).

    Vectors are linked if their labels are equal and not null, their lengths are equal and their cosine in double precision is at least
    ``similarity``.  Unusable vectors (null, zero, null or non-finite components) and vectors of null label link with nothing: n_links 0, their
    own component.  Equal rows are vectors of their own that link with each other; vectors of one key are one node of the
    graph.  A null key takes part; components of null keys alone have a null id and are kept.  Extra columns are ignored.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vec"), F.col(label).alias("label"))
    rows = save(rows.withColumn("ok", usable(F.col("vec")) & F.col("label").isNotNull()).withColumn("vh", F.xxhash64("vec")))
    ok = rows.where("ok")
    # one class for equal vectors of a label; saved, so its number stays
    classes = save(ok.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("key").alias("low")).withColumn("id", F.monotonically_increasing_id()))
    count = classes.count()
    dims = [r[0] for r in classes.select(F.size("vec")).distinct().limit(1).collect()]
    if not dims:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    # cells are laid for the most usual length; vectors of other lengths meet in one cell a label and length
    dim = classes.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    centres = fit(classes.where(F.size("vec") == dim), max(4, min(1024, count // PER_CELL)))
    reach = math.sqrt(max(0.0, 2 - 2 * similarity)) + 1e-7
    shared = spark.sparkContext.broadcast(centres)

    def place(batches):
        c = shared.value
        apart = reach * np.sqrt(np.maximum(0.0, ((c[:, None] - c[None]) ** 2).sum(axis=2)))
        for pdf in batches:
            home = np.zeros(len(pdf), dtype=np.int64)
            cells = [[0]] * len(pdf)
            same = np.flatnonzero(pdf["vec"].map(len) == c.shape[1])
            if len(same):
                dots = unit(pdf["vec"].iloc[same]) @ c.T
                for k, d in zip(same, dots):
                    home[k] = d.argmax()
                    cells[k] = np.flatnonzero((d[None, :] - apart).max(axis=1) <= d + 1e-9).tolist()
            yield pd.DataFrame({"id": pdf["id"], "home": home, "cells": cells})

    placed = classes.select("id", "vec").mapInPandas(place, "id long, home long, cells array<long>")
    placed = save(classes.select("id", "label", "vec", "n", F.size("vec").alias("d")).join(placed, "id"))
    at = placed.select("id", "label", "d", "vec", "n", "home", F.explode("cells").alias("cell"))
    # blocks: as many on either side as keep a product bounded, whatever the size of a cell
    sizes = at.groupBy("label", "d", "cell").agg(F.sum((F.col("home") == F.col("cell")).cast("int")).alias("homes"), F.count("*").alias("visits"))
    sizes = sizes.where("homes > 0").select("label", "d", "cell", F.ceil(F.col("homes") / BLOCK).cast("int").alias("hb"),
                                            F.ceil(F.col("visits") / (2 * BLOCK)).cast("int").alias("vb"))
    at = at.join(sizes, ["label", "d", "cell"])
    one = at.where("home = cell").withColumn("p", F.pmod(F.xxhash64("id"), F.col("hb")).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.col("vb") - 1))).withColumn("side", F.lit(0))
    two = at.withColumn("q", F.pmod(F.xxhash64("id", F.lit(3)), F.col("vb")).cast("int")).withColumn(
        "p", F.explode(F.sequence(F.lit(0), F.col("hb") - 1))).withColumn("side", F.lit(1))
    cols = ["label", "d", "cell", "p", "q", "side", "id", "n", "vec"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "links": [], "lead": []}).astype("int64")
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        near = (unit(left["vec"]) @ unit(right["vec"]).T >= similarity) & (a[:, None] != b[None, :])
        links = near @ right["n"].to_numpy()
        i, j = np.nonzero(near)
        nodes = np.unique(np.concatenate([a[i], b[j]]))
        lead = forest(np.searchsorted(nodes, a[i]), np.searchsorted(nodes, b[j]), len(nodes))
        # counts of the home side, and the forest of both
        return pd.concat([pd.DataFrame({"id": a, "links": links, "lead": a}), pd.DataFrame({"id": nodes, "links": 0, "lead": nodes[lead]})])

    both = one.select(cols).union(two.select(cols)).groupBy("label", "d", "cell", "p", "q")
    found = save(both.applyInPandas(compare, "id long, links long, lead long").where("links > 0 or id <> lead"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    # classes of one key are one node
    low = classes.groupBy("low").agg(F.min("id").alias("lead"), F.count("*").alias("c")).where("c > 1 and low is not null")
    joined = classes.join(low, "low").select(F.col("id").alias("a"), F.col("lead").alias("b"))
    comp = components(spark, found.select(F.col("id").alias("a"), F.col("lead").alias("b")).union(joined))
    whole = classes.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    lead = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    whole = whole.join(lead, "component").join(links, "id", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(whole.withColumn("vh", F.xxhash64("vec")).withColumn("ok", F.lit(True)), ["ok", "label", "vh", "vec"], "left")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id")))
