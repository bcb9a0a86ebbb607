"""Population stability of many features in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bin_index, drift_verdict
from .guards import require_columns
from .quantiles import exact_quantiles, unique_edges
from .small import literal_frame

Edges = dict[str, list[float]]


def fit_reference_edges(
    reference: DataFrame, features: Sequence[str], bins: int = K.PSI_BINS, decimals: int | None = None, **opts
) -> Edges:
    """Distinct quantile edges per feature, (features x (bins + 1)) numbers."""
    q = exact_quantiles(reference, features, [i / bins for i in range(bins + 1)], **opts)
    missing = [f for f in features if f not in q]
    if missing:
        raise ValueError(f"reference has no values for {', '.join(missing)}")
    return {f: unique_edges(v, decimals) for f, v in q.items()}


def edges_frame(spark, edges: Edges, open_ended: bool = False) -> DataFrame:
    rows = [(f, _opened(e, open_ended)) for f, e in edges.items()]
    return F.broadcast(literal_frame(spark, rows, "feature string, edges array<double>"))


def bin_counts(
    df: DataFrame, features: Sequence[str], edges: Edges, by: Sequence[str | Column] = (), open_ended: bool = False
) -> DataFrame:
    """(by, feature, bin, n): histogram on the reference edges, left-closed with a closed last bin.

    Values outside the edges are dropped, as in the reference population's histogram, unless ``open_ended``.  Partial
    aggregation leaves (groups x features x bins) rows per task.
    """
    by_cols = [F.col(b) if isinstance(b, str) else b for b in by]
    binned = [
        bin_index(F.col(f"`{c}`").cast("double"), _opened(edges[c], open_ended), closed="left").alias(c)
        for c in features if len(edges[c]) > 1
    ]
    wide = df.select(*by_cols, *binned)
    names = wide.columns[: len(by_cols)]
    if not binned:
        return wide.limit(0).select(*names, F.lit("").alias("feature"), F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"))
    long = wide.unpivot(names, [f"`{c}`" for c in wide.columns[len(names):]], "feature", "bin")
    return long.where("bin IS NOT NULL").groupBy(*names, "feature", "bin").agg(F.count("*").alias("n"))


def _opened(edges: list[float], open_ended: bool) -> list[float]:
    return [-math.inf, *edges[1:-1], math.inf] if open_ended and len(edges) > 1 else edges


def bin_counts_long(long: DataFrame, edges: Edges, by: Sequence[str] = (), open_ended: bool = False) -> DataFrame:
    """The same for rows already in long form (by, feature, x), and for features without edges.

    Values outside the edges or of a feature without bins are counted under a NULL bin, so every (by, feature) that has values has a row.
    """
    table = edges_frame(long.sparkSession, edges, open_ended)
    binned = long.where("x IS NOT NULL").join(table, "feature", "left").withColumn(
        "bin", bin_index(F.col("x"), F.col("edges"), closed="left")
    )
    return binned.groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def psi_bins(
    counts: DataFrame, spark, edges: Edges, slice_col: str, reference: str, compared: Sequence[str]
) -> DataFrame:
    """Per-bin table (feature, compared, bin, bin_left, bin_right, ref_share, cmp_share, psi_contrib).

    ``counts`` is a bin table (small: slices x features x bins).  Every bin is listed, also when empty.
    """
    grid = edges_frame(spark, edges).where(F.size("edges") > 1).select(
        "feature", "edges", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin")
    )
    wide = counts.groupBy("feature", "bin").pivot(slice_col, [reference, *compared]).agg(F.sum("n"))
    full = grid.join(wide, ["feature", "bin"], "left").select(
        "feature", "bin", F.element_at("edges", F.col("bin") + 1).alias("bin_left"),
        F.element_at("edges", F.col("bin") + 2).alias("bin_right"),
        F.coalesce(F.col(f"`{reference}`"), F.lit(0)).alias("ref_n"),
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in compared],
    )
    long = full.unpivot(["feature", "bin", "bin_left", "bin_right", "ref_n"], [f"`{c}`" for c in compared], "compared", "cmp_n")
    totals = long.groupBy("feature", "compared").agg(F.sum("ref_n").alias("ref_t"), F.sum("cmp_n").alias("cmp_t"))
    ref = F.col("ref_n") / F.greatest("ref_t", F.lit(1))
    cmp = F.col("cmp_n") / F.greatest("cmp_t", F.lit(1))
    contrib = (F.col("ref_share") - F.col("cmp_share")) * F.ln(
        F.greatest("ref_share", F.lit(K.PSI_FLOOR)) / F.greatest("cmp_share", F.lit(K.PSI_FLOOR))
    )
    return long.join(totals, ["feature", "compared"]).withColumns({"ref_share": ref, "cmp_share": cmp}).select(
        "feature", "compared", "bin", "bin_left", "bin_right", "ref_share", "cmp_share", contrib.alias("psi_contrib")
    )


def psi_two_samples(
    reference: DataFrame, compared: DataFrame, feature: str, bins: int = K.PSI_BINS, open_ended: bool = False, **opts
) -> tuple[float, DataFrame]:
    """PSI of one feature between two frames, and its bin table.  0 when the reference is constant."""
    for name, df in (("reference", reference), ("compared", compared)):
        if df.isEmpty():
            raise ValueError(f"{name} sample is empty")
    edges = fit_reference_edges(reference, [feature], bins, **opts)
    tagged = reference.select(feature, F.lit("ref").alias("_slice")).unionByName(
        compared.select(feature, F.lit("cmp").alias("_slice"))
    )
    counts = bin_counts(tagged, [feature], edges, ["_slice"], open_ended)
    table = psi_bins(counts, reference.sparkSession, edges, "_slice", "ref", ["cmp"])
    return table.agg(F.coalesce(F.sum("psi_contrib"), F.lit(0.0)).alias("psi")).first().psi, table


def check_slices(df: DataFrame, features: Sequence[str]) -> None:
    require_columns(df, [K.SPLIT, *features])
    found = df.agg(*[F.bool_or(F.col(K.SPLIT) == s).alias(s) for s in K.SPLITS]).first()
    if not all(found[s] for s in K.SPLITS):
        raise ValueError(f"{K.SPLIT} must contain {', '.join(K.SPLITS)} rows")


def psi_bin_table(
    df: DataFrame, features: Sequence[str], bins: int = K.PSI_BINS, open_ended: bool = False,
    decimals: int | None = None,
) -> tuple[DataFrame, Edges]:
    check_slices(df, features)
    edges = fit_reference_edges(df.where(F.col(K.SPLIT) == "train"), features, bins, decimals)
    counts = bin_counts(df, features, edges, [K.SPLIT], open_ended)
    return psi_bins(counts, df.sparkSession, edges, K.SPLIT, "train", ["val", "test"]), edges


def compute_psi_table(
    df: DataFrame, features: Sequence[str], bins: int = K.PSI_BINS, open_ended: bool = False,
    decimals: int | None = None,
) -> DataFrame:
    """(feature, psi_train_vs_val, psi_train_vs_test, max_psi, drift_verdict, n_bins_used), worst first.

    Bins empty on both sides add nothing, so the sum needs no bin grid: one count per (feature, bin) with a column per slice,
    then one pass per feature over at most ``bins`` rows.
    """
    check_slices(df, features)
    edges = fit_reference_edges(df.where(F.col(K.SPLIT) == "train"), features, bins, decimals)
    counts = bin_counts(df, features, edges, [K.SPLIT], open_ended)
    per_bin = counts.groupBy("feature", "bin").agg(*[
        F.sum(F.when(F.col(K.SPLIT) == s, F.col("n")).otherwise(0)).alias(s) for s in K.SPLITS
    ])
    whole = Window.partitionBy("feature")
    shares = per_bin.select("feature", *[
        (F.col(s) / F.greatest(F.sum(s).over(whole), F.lit(1))).alias(s) for s in K.SPLITS
    ])
    floor = F.lit(K.PSI_FLOOR)
    psi = shares.groupBy("feature").agg(*[
        F.sum((F.col("train") - F.col(s)) * F.ln(F.greatest("train", floor) / F.greatest(s, floor))).alias(s)
        for s in ("val", "test")
    ])
    used = literal_frame(
        df.sparkSession, [(f, max(len(e) - 1, 0)) for f, e in edges.items()], "feature string, n_bins_used int"
    )
    val, test = F.coalesce("val", F.lit(0.0)), F.coalesce("test", F.lit(0.0))
    # one row per feature on both sides
    return used.join(F.broadcast(psi), "feature", "left").select(
        "feature", val.alias("psi_train_vs_val"), test.alias("psi_train_vs_test"), F.greatest(val, test).alias("max_psi"),
        drift_verdict(F.greatest(val, test)).alias("drift_verdict"), "n_bins_used",
    ).orderBy(F.desc("max_psi"), "feature")


def psi_summary(table: DataFrame) -> DataFrame:
    """Features per verdict with the worst feature of each."""
    return table.groupBy("drift_verdict").agg(
        F.count("*").alias("n_features"), F.max("max_psi").alias("worst_psi"),
        F.max(F.struct("max_psi", "feature"))["feature"].alias("worst_feature"),
    )


def psi_by_window(
    df: DataFrame, features: Sequence[str], window_col: str, edges: Edges, reference_counts: DataFrame
) -> DataFrame:
    """(window, feature, psi, drift_verdict): every window against one reference bin table (feature, bin, n)."""
    long = df.select(window_col, *[F.col(f"`{c}`").cast("double").alias(c) for c in features]).unpivot(
        window_col, [f"`{c}`" for c in features], "feature", "x"
    )
    return psi_from_counts(bin_counts_long(long, edges, [window_col]), window_col, edges, reference_counts)


def psi_from_counts(counts: DataFrame, window_col: str, edges: Edges, reference_counts: DataFrame) -> DataFrame:
    """(window, feature, psi, drift_verdict) for every (window, feature) of ``counts``.

    ``counts`` has the values outside the reference range under a NULL bin: they are in no share, but a window of nothing else has its full
    PSI.  Features without values in the reference have NULL; a constant one has no bins and NULL too.
    """
    spark = counts.sparkSession
    grid = edges_frame(spark, edges).where(F.size("edges") > 1).select(
        "feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin")
    )
    ref = grid.join(reference_counts, ["feature", "bin"], "left").select(
        "feature", "bin", F.coalesce("n", F.lit(0)).alias("ref_n")
    )
    ref_t = ref.groupBy("feature").agg(F.sum("ref_n").alias("ref_t"))
    # the grid is windows x features x bins: counts are complete per (window, feature), empty bins are added
    inside = F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)
    windows = counts.groupBy(window_col, "feature").agg(F.sum(inside).alias("cmp_t"))
    full = windows.join(ref, "feature", "left").join(ref_t.where("ref_t > 0"), "feature", "left").join(
        counts, [window_col, "feature", "bin"], "left"
    )
    r = F.col("ref_n") / F.greatest("ref_t", F.lit(1))
    c = F.coalesce("n", F.lit(0)) / F.greatest("cmp_t", F.lit(1))
    part = F.when(
        F.col("ref_t").isNotNull(), (r - c) * F.ln(F.greatest(r, F.lit(K.PSI_FLOOR)) / F.greatest(c, F.lit(K.PSI_FLOOR)))
    )
    out = full.groupBy(window_col, "feature").agg(F.sum(part).alias("psi"))
    return out.withColumn("drift_verdict", drift_verdict("psi"))


def psi_of_counts(before, now) -> Column:
    """PSI of two arrays of bin counts of one length; NULL if either has no rows."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, n: s + n)
    floor = F.lit(K.PSI_FLOOR)

    def part(p: Column, q: Column) -> Column:
        r, c = p / F.nullif(total(before), F.lit(0)), q / F.nullif(total(now), F.lit(0))
        return (r - c) * F.ln(F.greatest(r, floor) / F.greatest(c, floor))

    return F.aggregate(F.zip_with(before, now, part), F.lit(0.0), lambda s, x: s + x)


def psi_between_windows(counts: DataFrame, window_col: str, edges: Edges) -> DataFrame:
    """(window, feature, previous, n, psi, drift_verdict): each window of ``counts`` (window, feature, bin, n) against the last one before it.

    Windows and features without values inside the edges are no window: the next one is compared with the last that had any.  A feature's
    first window has NULL.  State per feature is one row a window.
    """
    bins = edges_frame(counts.sparkSession, edges).select("feature", (F.size("edges") - 1).alias("bins")).where("bins > 0")
    inside = counts.where("bin IS NOT NULL").groupBy(window_col, "feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("at"))
    wide = inside.join(bins, "feature").withColumn("c", F.transform(F.sequence(F.lit(0), F.col("bins") - 1), lambda b: F.coalesce(F.element_at("at", b), F.lit(0).cast("long"))))
    order = Window.partitionBy("feature").orderBy(window_col)
    steps = wide.withColumns({"previous": F.lag(window_col).over(order), "before": F.lag("c").over(order)})
    out = steps.select(window_col, "feature", "previous", F.aggregate("c", F.lit(0).cast("long"), lambda s, n: s + n).alias("n"), psi_of_counts(F.col("before"), F.col("c")).alias("psi"))
    return out.withColumn("drift_verdict", drift_verdict("psi"))


def drift_alert(psi: DataFrame, window_col: str, at_least: int = 3) -> DataFrame:
    """Windows in which enough features drifted strongly."""
    return psi.groupBy(window_col).agg(F.count_if(F.col("drift_verdict") == "major_drift").alias("n_major")).where(
        F.col("n_major") >= at_least
    )
