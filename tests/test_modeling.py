import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lendspark.plans import catalog, catalog_models
from lendspark.session import split_wide_projections
from lendspark import constants as K
from lendspark.operators import attribution as A
from lendspark.operators import modeling as M
from lendspark.operators import scoring as R
from lendspark.operators.metrics import areas
from lendspark.operators.selection import rank_merge, select_top_n
from lendspark.operators.splitting import fit_stratified_split, only
from lendspark.plans.pipeline import Stages, run_pipeline, score_portfolio
from lendspark.streaming import jobs

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 2), rng.gauss(0, 1)
        y = int(1.5 * a - 0.4 * (b - 5) + rng.gauss(0, 1) > 1.2)
        rows.append((i, y, None if i % 9 == 0 else a, b, c))
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, b double, c double")
    return fit_stratified_split(df).transform(df, K.SPLIT).persist()


def _auc(model, df):
    return areas(model.score(df), "score").first().roc_auc


@pytest.fixture(scope="module")
def logreg(frame):
    return M.train_logreg(only(frame, "train"), NAMES)


@pytest.fixture(scope="module")
def gbt(frame):
    return M.train_gbt(only(frame, "train"), NAMES, n_trees=5, max_depth=3, learning_rate=0.3)


def test_learners_find_the_signal(frame, logreg, gbt):
    test = only(frame, "test")
    rf = M.train_random_forest(only(frame, "train"), NAMES, n_trees=10, max_depth=5)
    assert _auc(logreg, test) > 0.85 and _auc(gbt, test) > 0.8 and _auc(rf, test) > 0.8
    with pytest.raises(ValueError):
        M.train_random_forest(frame, NAMES, imbalance="smote")


def test_network(frame):
    model = M.train_mlp(only(frame, "train"), only(frame, "val"), NAMES, hidden=(4, 3), iterations=(20, 40))
    assert _auc(model, only(frame, "test")) > 0.75 and model.config["best_val_auc"] > 0.75


def test_copies_balance_the_classes(frame):
    train = only(frame, "train")
    balance = M.class_balance(train)
    after = M.class_balance(M.balanced_copies(train, balance))
    assert after.neg == balance.neg and abs(after.pos / after.neg - 1) < 0.1


def test_weights(spark):
    b = M.ClassBalance(100, 10)
    assert b.scale_pos_weight == 9.0 and M.ClassBalance(5, 0).scale_pos_weight == 5.0
    df = spark.createDataFrame([(1,), (0,)], "TARGET int").select(b.weight("balanced").alias("w"))
    assert [r.w for r in df.collect()] == [5.0, 100 / 180]


def test_stored_model_scores_alike_and_never_refits(spark, frame, gbt, tmp_path):
    path = str(tmp_path / "m")
    gbt.save(path)
    test = only(frame, "test")
    first = {r.SK_ID_CURR: r.score for r in gbt.score(test).collect()}
    loaded = M.FittedModel("gbt", NAMES, PipelineModel.load(path))
    assert first == {r.SK_ID_CURR: r.score for r in loaded.score(test).collect()}
    assert first == {r.SK_ID_CURR: r.score for r in loaded.score(test.repartition(7)).collect()}


def test_fits_see_train_rows_only(frame, logreg):
    changed = frame.withColumn("a", F.when(F.col("SPLIT") == "train", F.col("a")).otherwise(99.0))
    again = M.train_logreg(only(changed, "train"), NAMES)
    assert np.allclose(again.classifier.coefficients.toArray(), logreg.classifier.coefficients.toArray())


def test_tuning_and_refit(frame):
    train, val = only(frame, "train"), only(frame, "val")
    best, trials = M.tune("logreg", train, val, NAMES, grid=[{"C": 0.001}, {"C": 1.0}])
    rows = trials.collect()
    assert len(rows) == 2 and sum(r.best for r in rows) == 1
    assert max(r.roc_auc for r in rows) == next(r.roc_auc for r in rows if r.best)
    final = M.refit_winner(best, frame, M.train_logreg, C=best.config["C"])
    assert _auc(final, only(frame, "test")) > 0.8


def test_cross_validation_and_hypotheses(frame):
    cv = M.cross_validated_auc(frame, {"all": NAMES, "noise": ["c"]}, k=3)
    mean = {r.feature_set: r.m for r in cv.groupBy("feature_set").agg(F.avg("roc_auc").alias("m")).collect()}
    assert mean["all"] > 0.85 > 0.65 > mean["noise"]
    h = {(r.model, r.term): r.coefficient for r in M.logit_hypotheses(frame, {"one": ["a"], "two": ["a", "b"]}).collect()}
    assert h["one", "a"] > 0 > h["two", "b"]


def _shapley(x, leaves, n):
    """Definition: average marginal contribution over all orders of the features."""
    def value(known):
        total = 0.0
        for v, conds in leaves:
            for f, lo, hi, share in conds:
                v *= (lo < x[f] <= hi) if f in known else share
            total += v
        return total

    phi = [0.0] * n
    for order in itertools.permutations(range(n)):
        for i, f in enumerate(order):
            phi[f] += value(set(order[:i + 1])) - value(set(order[:i]))
    return [p / math.factorial(n) for p in phi]


def test_attribution_equals_the_definition(spark, frame, gbt, tmp_path):
    leaves = A.tree_leaves(gbt, str(tmp_path / "t"))
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 3)) * [1, 2, 1] + [0, 5, 0]
    got = A.leaf_attributions(x, leaves)
    for row, phi in zip(x, got, strict=True):
        assert phi == pytest.approx(_shapley(row, leaves, 3), abs=1e-9)


def test_attributions_add_up(spark, frame, gbt, tmp_path):
    """Attributions plus the mean prediction give the raw margin of every row."""
    rows = only(frame, "test")
    leaves = A.tree_leaves(gbt, str(tmp_path / "a"))
    base = sum(v * math.prod(c[3] for c in conds) for v, conds in leaves)
    total = {r[K.ID]: r.s for r in A.attributions(gbt, rows, K.ID, str(tmp_path / "b")).groupBy(K.ID).agg(F.sum("attribution").alias("s")).collect()}
    for r in gbt.score(rows).collect():
        margin = math.log(r.score / (1 - r.score)) / 2
        assert total[r[K.ID]] + base == pytest.approx(margin, abs=1e-6)


def test_importances_agree_on_the_signal(spark, frame, gbt, tmp_path):
    shap = A.mean_abs_attribution(gbt, only(frame, "train"), K.ID, str(tmp_path / "x"))
    both = M.importances(gbt, "xgb_importance").join(M.importances(gbt, "rf_importance"), "feature")
    top = select_top_n(rank_merge(both), shap, 2).collect()
    assert [r.feature for r in top] == ["a", "b"] and 0 <= top[1].combined_score <= top[0].combined_score <= 1
    drop = {r.feature: r.auc_drop for r in A.permutation_importance(gbt, only(frame, "test"), K.ID, K.TARGET).collect()}
    assert max(drop, key=drop.get) == "a" and set(drop) == set(NAMES)


# -- scoring ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scorer(spark):
    rng = random.Random(2)
    rows = [(i, *[rng.gauss(0, 1) for _ in K.SCORER_INPUTS]) for i in range(500)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, " + ", ".join(f"`{c}` double" for c in K.SCORER_INPUTS))
    df = df.withColumn("TARGET", (F.col(K.SCORER_INPUTS[0]) < -0.5).cast("int")).persist()
    return df, M.train_logreg(df, K.SCORER_INPUTS)


def test_score_shape_and_policy(scorer):
    df, model = scorer
    out = R.score(df, model.pipeline, K.SCORER_INPUTS)
    assert set(out.columns) - set(df.columns) >= {"probability_of_default", "recommendation"}
    bad = out.where("NOT probability_of_default BETWEEN 0 AND 1 OR recommendation NOT IN ('Approve', 'Manual Review', 'Reject')")
    assert bad.count() == 0
    strict = R.score(df, model.pipeline, reject_from=0.0, approve_below=-1.0)
    assert strict.where("recommendation <> 'Reject'").count() == 0


def test_score_rejects_bad_input(scorer):
    df, model = scorer
    with pytest.raises(ValueError, match="EXT_SOURCE_MEAN"):
        R.score(df.drop("EXT_SOURCE_MEAN"), model.pipeline, K.SCORER_INPUTS)
    with pytest.raises(TypeError):
        R.score(["not a frame"], model.pipeline)


def test_scorer_inputs_are_distinct():
    assert len(K.SCORER_INPUTS) == len(set(K.SCORER_INPUTS)) == 30


def test_risk_falls_with_the_external_rating(spark):
    """Applicants with better external ratings get a lower probability, and the what-if table moves the right fields."""
    rng = random.Random(4)
    fields = ("SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, AGE_YEARS double, "
              "EMPLOYED_YEARS double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double, CODE_GENDER string, "
              "NAME_EDUCATION_TYPE string, NAME_CONTRACT_TYPE string, FLAG_OWN_CAR boolean, FLAG_DOCUMENT_3 boolean, REGION_POPULATION_RELATIVE double")
    rows = []
    for i in range(400):
        e = [rng.random() for _ in range(3)]
        rows.append((i, 150000.0, 300000.0, 25000.0, 280000.0, 40.0, float(i % 7), *e, "MF"[i % 2], "Academic degree", "Cash loans", True, i % 3 == 0, 0.018))
    forms = spark.createDataFrame(rows, fields)
    raw = R.raw_features(forms, "SK_ID_CURR")
    assert set(raw.columns) - {"SK_ID_CURR"} == set(K.SCORER_INPUTS)
    spec = R.fit_scorer_inputs(raw)
    labelled = spec.transform(raw).withColumn("TARGET", (F.col("EXT_SOURCE_MEAN") < -0.3).cast("int"))
    model = M.train_logreg(labelled, K.SCORER_INPUTS, max_iter=30)
    scored = R.score(spec.transform(raw), model.pipeline).join(forms.select("SK_ID_CURR", (F.col("EXT_SOURCE_1") + F.col("EXT_SOURCE_2")).alias("e")), "SK_ID_CURR")
    assert scored.select(F.corr("probability_of_default", "e")).first()[0] < -0.5
    what = R.sensitivity(forms.where("SK_ID_CURR = 7"), spec, model.pipeline, "SK_ID_CURR").collect()
    moved = {(r.field, r.direction): r for r in what}
    assert len(moved) == 16
    still = [r for r in what if r.base_value == 0]  # years employed are 0 for this applicant: nothing to move
    assert len(still) == 2 and all(r.probability_of_default is None and r.recommendation is None for r in still)
    assert moved["AGE_YEARS", "-10%"].new_value == 36.0 and moved["AMT_CREDIT", "+10%"].new_value == pytest.approx(330000)
    assert moved["EXT_SOURCE_2", "+10%"].probability_of_default < moved["EXT_SOURCE_2", "-10%"].probability_of_default


def test_streamed_scores_equal_batch_scores(spark, scorer, tmp_path):
    df, model = scorer
    df.drop("TARGET").repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = jobs.read_arrivals(spark, str(tmp_path / "in"), df.drop("TARGET").schema, 1)
    q = jobs.stream_scores(arriving, model.pipeline, str(tmp_path / "out"), str(tmp_path / "cp"), K.SCORER_INPUTS)
    q.awaitTermination(120)
    got = {r.SK_ID_CURR: (r.probability_of_default, r.recommendation) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.SK_ID_CURR: (r.probability_of_default, r.recommendation) for r in R.score(df, model.pipeline).collect()}
    assert got == want


# -- the stages end to end --------------------------------------------------------------------------------------------


def test_pipeline_end_to_end(spark, sf, tmp_path):
    from lendspark.plans.loans import APPLICATION, loans

    raw = loans(spark, sf, APPLICATION)
    out = run_pipeline(spark, raw, str(tmp_path), top_n=8, n_trees=3, select_trees=3)
    n = raw.count()
    assert spark.read.parquet(str(tmp_path / "clean")).count() == n
    clean, eng = (spark.read.parquet(str(tmp_path / d)).select(K.ID, K.SPLIT) for d in ("clean", "engineered"))
    assert clean.exceptAll(eng).count() == 0 and {r.SPLIT for r in clean.select(K.SPLIT).distinct().collect()} == set(K.SPLITS)
    assert set(K.ENGINEERED) <= set(spark.read.parquet(str(tmp_path / "engineered")).columns)
    report = out["report"].collect()
    assert {(r.model, r.SPLIT) for r in report} == {(m, s) for m in ("gbt", "logreg") for s in ("val", "test")}
    for r in report:
        assert all(0 <= r[m] <= 1 for m in ("roc_auc", "pr_auc", "precision", "recall", "f1", "accuracy"))
    assert out["drift"].count() == 8
    decisions = score_portfolio(spark, Stages(str(tmp_path)), [r.feature for r in out["drift"].collect()])
    assert decisions.count() == n and decisions.where("recommendation IS NULL").count() == 0


@pytest.mark.parametrize("name", ["form_to_features", "sensitivity_scores"])
def test_scorer_fits_hash_nothing_again(spark, sf, name, monkeypatch):
    """Every pass of the fit reads tagged rows; it derives neither the split's hash nor the inputs again."""
    plans, fit = [], catalog_models.R.fit_scorer_inputs
    monkeypatch.setattr(catalog_models.R, "fit_scorer_inputs", lambda train: plans.append(train._jdf.queryExecution().optimizedPlan().toString()) or fit(train))
    own = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        catalog.QUERIES[name](spark, sf)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
        split_wide_projections(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"  # the session's own
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", own)
    assert plans and "md5" not in plans[0]
