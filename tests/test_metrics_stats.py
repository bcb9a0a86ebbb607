import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendspark.functions.distributions import chi2_log10_p, t_log10_p
from lendspark.operators import metrics as M
from lendspark.operators import stats as T
from lendspark.operators.ordering import running_sums


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        y = int(rng.random() < 0.3)
        rows.append((i, y, 0.5 if i % 3 == 0 else round(min(max(rng.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0), 2)))
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, score double").persist()


def _brute(scored):
    rows = [(r.score, r.TARGET) for r in scored.collect()]
    pos, neg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    tp = fp = 0
    steps = []
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(y for v, y in rows if v == s)
        fp += sum(1 - y for v, y in rows if v == s)
        steps.append((s, tp, fp))
    return steps, pos, neg


@pytest.mark.parametrize("bound", [1_000_000, 7])
def test_curves_equal_brute_force(scored, bound):
    """With a tiny bound the curve runs through many range buckets."""
    steps, pos, neg = _brute(scored)
    roc = {r.threshold: (r.fpr, r.tpr) for r in M.roc_curve(scored, "score", single_task_rows=bound).collect()}
    assert roc == {s: (fp / neg, tp / pos) for s, tp, fp in steps}
    roc_area = pr_area = 0.0
    last = (0, 0)
    for _, tp, fp in steps:
        roc_area += (fp - last[1]) / neg * (tp + last[0]) / 2 / pos
        p0 = last[0] / sum(last) if sum(last) else 1.0
        pr_area += (tp - last[0]) / pos * (tp / (tp + fp) + p0) / 2
        last = (tp, fp)
    got = M.areas(scored, "score", single_task_rows=bound).first()
    assert (got.roc_auc, got.pr_auc) == pytest.approx((roc_area, pr_area), abs=1e-12)
    best = max(((tp / pos - fp / neg, s) for s, tp, fp in steps))
    y = M.youden_threshold(scored, "score", single_task_rows=bound).first()
    assert (y.j, y.threshold) == pytest.approx(best)


def test_auc_equals_the_evaluator(scored):
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="TARGET", numBins=0)
    assert M.roc_auc(scored, "score").first().roc_auc == pytest.approx(ev.evaluate(scored), abs=1e-12)


def test_grouped_buckets(spark, scored):
    both = scored.withColumn("g", F.when(F.col("SK_ID_CURR") % 3 == 0, "hot").otherwise("rest"))
    wide = {(r.g, r.threshold): r.tpr for r in M.roc_curve(both, "score", ["g"]).collect()}
    assert wide == {(r.g, r.threshold): r.tpr for r in M.roc_curve(both, "score", ["g"], single_task_rows=5).collect()}


def test_running_sums_keep_every_row(spark):
    df = spark.createDataFrame([(i / 7, i) for i in range(500)], "x double, n long")
    got = {r.x: r.c for r in running_sums(df, "x", {"c": "n"}, descending=False, single_task_rows=9).collect()}
    assert got == {i / 7: i * (i + 1) // 2 for i in range(500)}


def test_confusion_follows_definitions(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "score double, TARGET int")
    r = M.confusion_metrics(df, "score").first()
    assert (r.tn, r.fp, r.fn, r.tp, r.precision, r.recall, r.f1, r.accuracy) == (1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5)
    none = M.confusion_metrics(df, "score", 2.0).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_published_confusion_ratios(spark):
    """Ratios of a known confusion matrix."""
    df = spark.createDataFrame([(30049, 12354, 1222, 2502)], "tn long, fp long, fn long, tp long")
    r = M.with_ratios(df).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == pytest.approx((0.1684, 0.6719, 0.2693, 0.7057), abs=5e-5)


def test_threshold_choice(spark):
    sharp = spark.createDataFrame([(0.3, 1)] * 50 + [(0.1, 0)] * 50, "score double, TARGET int")
    assert M.choose_threshold(sharp, "score").first().threshold == 0.3
    fine = spark.createDataFrame([(0.8, 1)] * 50 + [(0.1, 0)] * 50, "score double, TARGET int")
    assert M.choose_threshold(fine, "score").first().threshold == 0.5


def test_exemplars(spark, scored):
    ordered = sorted((r.score, r.SK_ID_CURR) for r in scored.collect())
    got = {r.risk: (r.score, r.SK_ID_CURR) for r in M.score_exemplars(scored, "score").collect()}
    assert got == {"low": ordered[0], "mid": ordered[1500], "high": ordered[-1]}


def test_nested_and_flat_reports(scored):
    long = scored.withColumns({"model": F.lit("m"), "SPLIT": F.when(F.col("SK_ID_CURR") % 2 == 0, "val").otherwise("test")})
    report = M.model_report(long)
    doc = M.nested_report(report).first()
    cm = doc.models["m"]["val"].confusion_matrix
    assert sum(cm) == 1500 and 0 <= doc.models["m"]["test"].roc_auc <= 1
    assert {r.key for r in M.flatten_report(report, "r").collect()} >= {"val_roc_auc", "test_f1"}


def test_correlation_ignores_missing_pairs(spark):
    rng = random.Random(1)
    rows = [(rng.random(), None if i % 4 == 0 else rng.gauss(1e6, 1), float(i), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, TARGET int").repartition(5)
    got = {(r.a, r.b): (r.n, r.r) for r in T.correlation_matrix(df, ["a", "b", "c"]).collect()}
    for (a, b), (n, r) in got.items():
        assert n == df.dropna(subset=[a, b]).count()
        assert r == pytest.approx(df.dropna(subset=[a, b]).select(F.corr(a, b)).first()[0], abs=1e-9)
    assert T.correlation_matrix(df.withColumn("k", F.lit(1.0)), ["a", "k"]).first().r is None


@pytest.mark.parametrize(("stat", "dof", "p"), [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.5, 3, 0.918891)])
def test_chi_square_tail(spark, stat, dof, p):
    got = spark.range(1).select(chi2_log10_p(F.lit(stat), F.lit(dof)).alias("l")).first().l
    assert 10**got == pytest.approx(p, rel=1e-5)


@pytest.mark.parametrize(("t", "dof", "p"), [(2.2281388519649385, 10, 0.05), (-1.959964, 10_000_000, 0.05), (0.0, 5, 1.0), (12.706204736, 1, 0.05)])
def test_student_tail(spark, t, dof, p):
    got = spark.range(1).select(t_log10_p(F.lit(t), F.lit(dof)).alias("l")).first().l
    assert 10**got == pytest.approx(p, rel=1e-5)


def test_tiny_p_values_stay_finite(spark):
    got = spark.range(1).select(t_log10_p(F.lit(100.0), F.lit(300000)).alias("l")).first().l
    assert -2300 < got < -2000


def test_chi_square_small_table(spark):
    rows = [("x", 0)] * 10 + [("x", 1)] * 20 + [("y", 0)] * 30 + [("y", 1)] * 15 + [(None, 1)] * 9
    r = T.chi_square(spark.createDataFrame(rows, "c string, TARGET int"), ["c"]).first()
    # 2 x 2 with continuity correction
    n, a, b, c, d = 75, 10, 20, 30, 15
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert (r.n, r.dof) == (75, 1) and r.chi2 == pytest.approx(want) and r.cramers_v == pytest.approx((want / n) ** 0.5)


def test_carry_forward(spark):
    folds = spark.createDataFrame([("top", 0, 0.70), ("top", 1, 0.72), ("all", 0, 0.71), ("all", 1, 0.73)],
                                  "feature_set string, fold int, roc_auc double")
    r = T.carry_forward(T.fold_summary(folds), "top", "all").first()
    assert r.delta == pytest.approx(-0.01) and r.auc_small == pytest.approx(0.71)
    assert T.carry_forward(T.fold_summary(folds), "top", "all", 0.005).first().carry_forward == "all"


def test_many_split_values_and_zero_inputs_and_gaps(spark):
    from pyspark.sql import functions as F

    from lendspark.operators.balance import smote_rows
    from lendspark.operators.drift import check_slices
    from lendspark.operators.metrics import areas, model_report, youden_threshold

    names = ["train", "val", "test", *[f"other{k}" for k in range(30)]]
    check_slices(spark.createDataFrame([(n, 1.0) for n in names[::-1]], "SPLIT string, x double"), ["x"])
    with pytest.raises(ValueError):
        check_slices(spark.createDataFrame([("train", 1.0), ("val", 1.0)], "SPLIT string, x double"), ["x"])
    # thresholds above 1 are passed over, the rows behind them count
    rows = [("a", 1.4, 1), ("a", 1.2, 1), ("a", 0.8, 1), ("a", 0.7, 1), ("a", 0.6, 0), ("a", 0.5, 1), (None, 0.9, 1), (None, 0.1, 0)]
    df = spark.createDataFrame(rows, "model string, score double, TARGET int").withColumn("SPLIT", F.lit("val"))
    best = {r.model: (r.threshold, round(r.j, 6)) for r in youden_threshold(df, "score", ["model"]).collect()}
    assert best == {"a": (0.7, 0.8), None: (0.9, 1.0)}
    assert {r.model for r in areas(df, "score", ["model"], single_task_rows=2).collect()} == {"a", None}
    assert {r.model for r in model_report(df).collect()} == {"a", None}
    # every minority row is a source, also with gaps
    train = spark.createDataFrame([(k, int(k < 40), float(k), None if k % 2 else float(k % 7)) for k in range(400)],
                                  "SK_ID_CURR long, TARGET int, x double, y double")
    made = smote_rows(train, ["x", "y"])
    assert made.select("source_id").distinct().count() == 40 and made.count() == 320
    assert smote_rows(train.where("TARGET = 1"), ["x", "y"]).columns == made.columns
