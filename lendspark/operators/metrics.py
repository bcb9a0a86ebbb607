"""Threshold metrics, ROC / PR curves and areas, exact and distributed.

Rows are first summed per (group, score); a hot score is one row per task.  Curves need global running totals, which come
from the two-level prefix sum in ``ordering``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from .ordering import join_groups, running_sums


def confusion_metrics(
    df: DataFrame, score: str, threshold: float | Column = 0.5, by: Sequence[str] = (), target: str = K.TARGET
) -> DataFrame:
    """Confusion counts, precision, recall, F1 and accuracy per group; 0 where a ratio has no denominator."""
    hit, pos = F.col(score) >= threshold, F.col(target) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(~hit & ~pos).alias("tn"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(hit & pos).alias("tp"),
    )
    return with_ratios(counts)


def with_ratios(counts: DataFrame) -> DataFrame:
    """Add the ratios that follow from tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "accuracy": ratio(tn + tp, tn + fp + fn + tp),
    })


def score_steps(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    """Per distinct score, highest first: cumulative ``tp``/``fp`` and the group totals ``pos``/``neg``.

    The counts per score are read three times (splitters, totals, running sums), so they are stored: the rows themselves are
    scanned once.
    """
    by = list(by)
    per = df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(target) == 1).alias("p"), F.count_if(F.col(target) != 1).alias("q")
    )
    per = materialize(per)
    steps = running_sums(per, score, {"tp": "p", "fp": "q"}, by, **opts)
    totals = per.groupBy(*by).agg(F.sum("p").alias("pos"), F.sum("q").alias("neg"))
    if by:
        return join_groups(steps, totals, by)
    t = totals.first()
    return steps.withColumns({"pos": F.lit(t.pos), "neg": F.lit(t.neg)})


def roc_curve(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    """(group, threshold, fpr, tpr); the anchor (0, 0) is implied.  Groups without both classes have NULL rates."""
    s = score_steps(df, score, by, target, **opts)
    return s.select(
        *by, F.col(score).alias("threshold"),
        F.try_divide(F.col("fp"), F.col("neg")).alias("fpr"), F.try_divide(F.col("tp"), F.col("pos")).alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    """(group, threshold, precision, recall); the anchor (recall 0, precision 1) is implied."""
    s = score_steps(df, score, by, target, **opts)
    return s.select(
        *by, F.col(score).alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("pos")).alias("recall"),
    )


def areas(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    """(group, pos, neg, roc_auc, pr_auc).

    ROC-AUC gives half credit to ties; PR-AUC is the trapezoid from (recall 0, precision 1).  Both need only a step and
    the totals before it, so no row looks at its neighbour.
    """
    s = score_steps(df, score, by, target, **opts)
    tp0, fp0 = F.col("tp") - F.col("p"), F.col("fp") - F.col("q")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec0 = F.when(tp0 + fp0 > 0, tp0 / F.nullif(tp0 + fp0, F.lit(0))).otherwise(1.0)
    # products of counts can pass 2^63 on large tables, so the pair count is summed as DOUBLE shares
    roc = F.try_divide(F.col("q"), F.col("neg")) * F.try_divide(tp0 + F.col("p") / 2, F.col("pos"))
    pr = F.try_divide(F.col("p"), F.col("pos")) * (prec + prec0) / 2
    return s.groupBy(*by).agg(
        F.max("pos").alias("pos"), F.max("neg").alias("neg"), F.sum(roc).alias("roc_auc"), F.sum(pr).alias("pr_auc")
    )


def roc_auc(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    return areas(df, score, by, target, **opts).drop("pr_auc")


def youden_threshold(df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, **opts) -> DataFrame:
    """(group, threshold, j): the score up to 1 with the largest TPR - FPR, the highest on ties; rates are of all rows."""
    curve = roc_curve(df, score, by, target, **opts).where("threshold <= 1")
    best = F.max(F.struct((F.col("tpr") - F.col("fpr")).alias("j"), F.col("threshold").alias("t")))
    return curve.groupBy(*by).agg(best.alias("b")).select(*by, F.col("b.t").alias("threshold"), F.col("b.j").alias("j"))


def choose_threshold(
    df: DataFrame, score: str, by: Sequence[str] = (), target: str = K.TARGET, fixed: float = 0.5, gain: float = 0.20,
    **opts,
) -> DataFrame:
    """Youden's threshold only when its J beats that of the fixed threshold by ``gain``; else the fixed one."""
    by = list(by)
    c = confusion_metrics(df, score, fixed, by, target)
    spec = F.col("tn") / F.greatest(F.col("tn") + F.col("fp"), F.lit(1))
    base = c.select(*by, (F.col("recall") + spec - 1).alias("j_fixed"))
    best = youden_threshold(df, score, by, target, **opts).withColumnsRenamed({"threshold": "t_youden", "j": "j_youden"})
    if by:
        both = join_groups(best, base, by)
    else:  # two one-row results
        b = base.first()
        both = best.withColumn("j_fixed", F.lit(b.j_fixed))
    use = F.col("j_youden") - F.col("j_fixed") >= gain
    return both.select(
        *by, F.when(use, F.col("t_youden")).otherwise(fixed).alias("threshold"),
        F.when(use, F.col("j_youden")).otherwise(F.col("j_fixed")).alias("j"), "t_youden", "j_youden", "j_fixed",
    )


def model_report(
    scored: DataFrame, score: str = "score", by: Sequence[str] = ("model", K.SPLIT), threshold: float = 0.5,
    target: str = K.TARGET,
) -> DataFrame:
    """All metrics per model and slice from one scored frame."""
    by = list(by)
    return join_groups(
        areas(scored, score, by, target).drop("pos", "neg"), confusion_metrics(scored, score, threshold, by, target), by
    ).withColumn("threshold", F.lit(threshold))


def nested_report(report: DataFrame, primary: str = "roc_auc") -> DataFrame:
    """The report as one document: model -> slice -> metrics with the confusion matrix inside.

    The report has one row per model and slice, so collecting it into a map is bounded by the models compared.
    """
    metrics = F.struct(
        "roc_auc", "pr_auc", "precision", "recall", "f1", "accuracy", "threshold",
        F.struct(F.col("tn").alias("TN"), F.col("fp").alias("FP"), F.col("fn").alias("FN"), F.col("tp").alias("TP"))
        .alias("confusion_matrix"),
    )
    def as_map(key: str, value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct(key, value)))

    per_model = report.select("model", K.SPLIT, metrics.alias("m")).groupBy("model").agg(as_map(K.SPLIT, "m").alias("slices"))
    return per_model.agg(as_map("model", "slices").alias("models")).select(F.lit(primary).alias("primary_metric"), "models")


def flatten_report(report: DataFrame, run_id: str) -> DataFrame:
    """Long run log (run_id, model, key, value) with keys such as ``val_roc_auc``."""
    names = ["roc_auc", "pr_auc", "precision", "recall", "f1", "accuracy"]
    long = report.unpivot(["model", K.SPLIT], names, "metric", "value")
    return long.select(
        F.lit(run_id).alias("run_id"), "model", F.concat_ws("_", K.SPLIT, "metric").alias("key"), "value"
    )


def score_exemplars(df: DataFrame, score: str, id_col: str = K.ID) -> DataFrame:
    """The rows with the lowest, the middle and the highest score (ties by id).

    Two ends and one middle rank: the ends are top-1 reductions; the middle is found through counts per score, so that only
    the rows sharing its score are ranked.
    """
    rows = df.where(F.col(score).isNotNull())
    per = rows.groupBy(score).agg(F.count("*").alias("c"))
    steps = running_sums(per, score, {"upto": "c"}, descending=False)
    n = rows.count()
    mid = n // 2 + 1
    at = steps.where((F.col("upto") >= mid) & (F.col("upto") - F.col("c") < mid)).first()
    tied = rows.where(F.col(score) == at[score])
    middle = _kth_by_id(tied, id_col, mid - (at.upto - at.c))
    low = rows.orderBy(F.asc(score), F.asc(id_col)).limit(1)
    high = rows.orderBy(F.desc(score), F.desc(id_col)).limit(1)
    return (
        low.withColumn("risk", F.lit("low")).unionByName(middle.withColumn("risk", F.lit("mid")))
        .unionByName(high.withColumn("risk", F.lit("high")))
    )


def _kth_by_id(rows: DataFrame, id_col: str, k: int) -> DataFrame:
    ids = rows.groupBy(id_col).agg(F.count("*").alias("c"))
    steps = running_sums(ids, id_col, {"upto": "c"}, descending=False)
    hit = steps.where((F.col("upto") >= k) & (F.col("upto") - F.col("c") < k)).first()
    return rows.where(F.col(id_col) == hit[id_col]).limit(1)
