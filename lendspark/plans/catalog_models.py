"""Queries: models fitted on the loan book.  Their scores depend on the learner, so most have no SQL form."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import attribution as A
from ..operators import balance as B
from ..operators import metrics as M
from ..operators import modeling as M_
from ..operators import scoring as R
from ..operators import selection as L
from ..operators import stats as T
from ..operators.cleaning import fix_sentinel
from ..operators.boosting import fit_cuts, train_boosted
from ..operators.forest import train_forest
from ..operators.engineering import REQUIRED, credit_to_income, engineer_features, standardized
from ..operators.neighbors import nearest_neighbours
from ..operators.network import train_network
from ..operators.newton import Design, fit_logistics
from ..operators.quantiles import exact_quantiles
from ..operators.splitting import fit_stratified_split, only
from ..session import materialize, split_wide_projections, together
from . import sqlparts as S
from .catalog_metrics import _FORM
from .loans import loans
from .registry import query

FEATURES = ["AGE_YEARS", "EMPLOYED_YEARS", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_GOODS_RATIO",
            "EXT_SOURCE_MEAN", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "CNT_FAM_MEMBERS"]
INPUTS = list(K.SCORER_INPUTS)
TOP = 15  # inputs that selection keeps
_KEPT: dict[tuple, object] = {}


def kept(spark, sf, name, make):
    """A fitted model or written table, made once a session: several queries report on the same fit."""
    key = spark.sparkContext.applicationId, sf, name
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def model_frame(spark, sf, features=tuple(FEATURES)):
    """Engineered, split-tagged rows.  Materialized: the fits below read them many times."""
    eng = engineer_features(fix_sentinel(loans(spark, sf, ["SK_ID_CURR", "TARGET", *REQUIRED])))
    eng = eng.select("SK_ID_CURR", "TARGET", *features)
    split = fit_stratified_split(loans(spark, sf, ["SK_ID_CURR", "TARGET"]))  # the cuts need no joins
    return materialize(split.transform(eng, K.SPLIT))


def input_frame(spark, sf):
    """All 30 scorer inputs, split-tagged, missing values kept."""
    def make():
        raw = R.raw_features(R.applicant_forms(loans(spark, sf, ["TARGET", *_FORM])), K.ID, K.TARGET)
        split = fit_stratified_split(loans(spark, sf, ["SK_ID_CURR", "TARGET"]))
        return materialize(split.transform(raw, K.SPLIT))

    return kept(spark, sf, "inputs", make)


def input_cuts(spark, sf):
    """Bins of the inputs, fitted on train rows; all tree models share them."""
    return kept(spark, sf, "cuts", lambda: fit_cuts(only(input_frame(spark, sf), "train"), INPUTS))


def boosted(spark, sf):
    """The documented classifier: 300 trees of depth 4, rate 0.05."""
    return kept(spark, sf, "gbt", lambda: train_boosted(only(input_frame(spark, sf), "train"), INPUTS, cuts=input_cuts(spark, sf)))


def network(spark, sf):
    df = input_frame(spark, sf)
    return kept(spark, sf, "mlp", lambda: train_network(only(df, "train"), only(df, "val"), INPUTS, id_col=K.ID))


def forest(spark, sf):
    """The documented classifier: 300 trees of depth 12 with at least 20 rows a leaf, classes balanced in each tree's rows."""
    return kept(spark, sf, "rf", lambda: train_forest(only(input_frame(spark, sf), "train"), INPUTS, id_col=K.ID, cuts=input_cuts(spark, sf)))


def selection_forest(spark, sf):
    """200 trees of depth 12, classes balanced once."""
    return kept(spark, sf, "selection rf", lambda: train_forest(only(input_frame(spark, sf), "train"), INPUTS, n_trees=200, imbalance="balanced_once", id_col=K.ID,
                                                                 cuts=input_cuts(spark, sf)))


def selection_trees(spark, sf):
    """300 boosted trees of depth 6 at rate 0.1."""
    return kept(spark, sf, "selection gbt", lambda: train_boosted(only(input_frame(spark, sf), "train"), INPUTS, n_trees=300, max_depth=6, learning_rate=0.1,
                                                                   cuts=input_cuts(spark, sf)))


def attribution_table(spark, sf):
    """Mean attributions of the selection trees over all train rows."""
    def make():
        return materialize(A.mean_abs_attribution(selection_trees(spark, sf), only(input_frame(spark, sf), "train"), K.ID))

    return kept(spark, sf, "shap", make)


def selection(spark, sf):
    """Both importances and the attribution, merged into one ranking of TOP inputs."""
    input_cuts(spark, sf)
    trees, forest_ = together(lambda: selection_trees(spark, sf), lambda: selection_forest(spark, sf))
    both = M_.importances(trees, "xgb_importance").join(M_.importances(forest_, "rf_importance"), "feature")
    return L.numbered(L.select_top_n(L.rank_merge(both), attribution_table(spark, sf), TOP))


def selected_list(spark, sf):
    return kept(spark, sf, "selected", lambda: [r.feature for r in selection(spark, sf).orderBy("position").collect()])


_SMOTE = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "DAYS_BIRTH"]


@query("smote_neighbors", """SELECT id, generate_subscripts(near, 1)::INT AS rank, unnest(near).n AS neighbour,
  round(unnest(near).d, 6) AS distance FROM (SELECT id, list_sort(arg_min(p, p, 5)) AS near FROM (
    SELECT a.SK_ID_CURR AS id, {'d': sqrt(""" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _SMOTE) + """),
      'n': b.SK_ID_CURR} AS p FROM pos a JOIN pos b ON a.SK_ID_CURR <> b.SK_ID_CURR) GROUP BY id)""", {
    **S.SPLIT_CTES,    "med": "SELECT " + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS m{i}" for i, c in enumerate(_SMOTE)) + " FROM tagged WHERE SPLIT = 'train'",
    "pos": "SELECT SK_ID_CURR, " + ", ".join(f"coalesce({c}::DOUBLE, m{i}) AS {c}" for i, c in enumerate(_SMOTE))
           + " FROM tagged, med WHERE SPLIT = 'train' AND TARGET = 1"})
def smote_neighbors(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", *_SMOTE])
    train = only(fit_stratified_split(df).transform(df, K.SPLIT), "train")
    medians = {c: q[0] for c, q in exact_quantiles(train, _SMOTE, [0.5]).items()}
    rows = train.where("TARGET = 1").select(K.ID, *[F.col(c).cast("double").alias(c) for c in _SMOTE]).fillna(medians)
    near = nearest_neighbours(rows, K.ID, _SMOTE, 5)
    return near.withColumn("distance", F.round("distance", 6))


@query("smote_rows")
def smote_rows(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", *_SMOTE])
    return B.smote_rows(only(fit_stratified_split(df).transform(df, K.SPLIT), "train"), _SMOTE)


@query("logreg_scores")
def logreg_scores(spark, sf):
    df = model_frame(spark, sf)
    model = fit_logistics(only(df, "train"), [Design("logreg", tuple(FEATURES), 1.0, "balanced")])[0]
    return model.score(df.where("SPLIT <> 'train'")).select(K.ID, K.SPLIT, K.TARGET, "score")


@query("gbt_scores")
def gbt_scores(spark, sf):
    return boosted(spark, sf).score(input_frame(spark, sf).where("SPLIT <> 'train'")).select(K.ID, K.SPLIT, K.TARGET, "score")


@query("rf_scores")
def rf_scores(spark, sf):
    return forest(spark, sf).score(input_frame(spark, sf).where("SPLIT <> 'train'")).select(K.ID, K.SPLIT, K.TARGET, "score")


@query("mlp_scores")
def mlp_scores(spark, sf):
    return network(spark, sf).score(only(input_frame(spark, sf), "test")).select(K.ID, K.SPLIT, K.TARGET, "score")


@query("model_comparison")
def model_comparison(spark, sf):
    """All four families on validation and test rows; the winner has the largest validation AUC."""
    df = input_frame(spark, sf)
    input_cuts(spark, sf)
    # the boosted trees and the network are long tasks of few cores, so the others fill the rest
    gbt, mlp, logreg, rf = together(lambda: boosted(spark, sf), lambda: network(spark, sf),
                                    lambda: fit_logistics(only(df, "train"), [Design("logreg", tuple(INPUTS), 1.0, "balanced")])[0], lambda: forest(spark, sf))
    models = [logreg, rf, gbt, mlp]
    report = materialize(M.model_report(M_.score_all(models, df.where("SPLIT <> 'train'"))))
    # four models, so one row leads them all
    winner = report.where("SPLIT = 'val'").orderBy(F.desc("roc_auc"), F.desc("f1"), "model").limit(1).select(F.col("model").alias("best"))
    return report.crossJoin(winner).withColumn("winner", F.col("model") == F.col("best")).drop("best")


@query("tune_trials")
def tune_trials(spark, sf):
    df = input_frame(spark, sf)
    return M_.tune_all(only(df, "train"), only(df, "val"), INPUTS)[1]


@query("cv_auc")
def cv_auc(spark, sf):
    """All inputs against the selected ones."""
    sets = {"all": INPUTS, "top": selected_list(spark, sf)}
    return M_.cross_validated_auc(input_frame(spark, sf).where("SPLIT <> 'test'"), sets, k=5)


@query("cv_summary")
def cv_summary(spark, sf):
    return T.carry_forward(T.fold_summary(cv_auc(spark, sf)), "top", "all")


@query("hypothesis_logit")
def hypothesis_logit(spark, sf):
    df = credit_to_income(loans(spark, sf, ["TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "EXT_SOURCE_3"]))
    df = materialize(standardized(df, "CTI", "CTI_C"))
    designs = {"linear": ["CTI_C"], "quadratic": ["CTI_C", "CTI_C2"], "controlled": ["CTI_C", "CTI_C2", "EXT_SOURCE_3"],
               "rating": ["EXT_SOURCE_3"]}
    return M_.logit_hypotheses(df, designs)


@query("imbalance_ab")
def imbalance_ab(spark, sf):
    """Class weights against synthetic rows, logistic and boosted."""
    features = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AGE_YEARS"]
    df = model_frame(spark, sf, tuple(features))
    train, val = only(df, "train"), only(df, "val")
    smote = materialize(B.with_smote(train, features))
    rows = []
    for name, trainer, weight, extra in (("logreg", M_.train_logreg, "balanced", {}), ("gbt", train_boosted, "pos_weight", {})):
        for how, data, mode in (("class_weight", train, weight), ("smote", smote, "none")):
            got = M_.evaluate(trainer(data, features, imbalance=mode, **extra), val, 0.5)
            rows.append((name, how, got["roc_auc"], got["f1"]))
    return spark.createDataFrame(rows, "model string, imbalance string, roc_auc double, f1 double")


@query("gbt_importance")
def gbt_importance(spark, sf):
    return M_.importances(selection_trees(spark, sf), "xgb_importance")


@query("rf_importance")
def rf_importance(spark, sf):
    return M_.importances(selection_forest(spark, sf), "rf_importance")


@query("mean_abs_attribution")
def mean_abs_attribution(spark, sf):
    return attribution_table(spark, sf)


@query("selected_features")
def selected_features(spark, sf):
    return selection(spark, sf)


@query("permutation_importance")
def permutation_importance(spark, sf):
    return A.permutation_importance(boosted(spark, sf), only(input_frame(spark, sf), "val"), K.ID, K.TARGET)


def scorer(spark, sf):
    """Scorer inputs, their spec, and a logistic model over all 30."""
    split_wide_projections(spark)
    book = materialize(loans(spark, sf, ["TARGET", *_FORM]))
    forms = R.applicant_forms(book)
    raw = materialize(fit_stratified_split(book).transform(R.raw_features(forms, K.ID, K.TARGET), K.SPLIT))  # hashed and derived once
    train = only(raw, "train").drop(K.SPLIT)
    raw = raw.drop(K.SPLIT)
    spec = R.fit_scorer_inputs(train)
    return forms, raw, spec, M_.train_logreg(train, K.SCORER_INPUTS, spec=spec)


@query("batch_score")
def batch_score(spark, sf):
    _, raw, _, model = scorer(spark, sf)
    return R.score(raw, model.pipeline, K.SCORER_INPUTS).select(K.ID, "probability_of_default", "recommendation")


@query("sensitivity_scores")
def sensitivity_scores(spark, sf):
    forms, _, _, model = scorer(spark, sf)
    tags = [K.ID, "field", "direction", "new_value"]
    scored = R.score(R.raw_features(R.perturbations(forms, K.ID), *tags), model.pipeline)
    return scored.select(*tags, R.moved_only("probability_of_default"), R.moved_only("recommendation"))
