"""Queries: imputation, encoding, splits, scaling and the cleaning pipeline."""

from __future__ import annotations

from .. import constants as K
from ..operators import cleaning as C
from ..operators.profiling import clean_sanity
from ..operators.scaling import class_weights, fit_model_input, fit_scaler
from ..operators.splitting import (
    fit_stratified_kfold,
    fit_stratified_split,
    only,
    sample_rows,
    split_membership,
)
from ..session import materialize
from . import sqlparts as S
from .loans import loans
from .registry import query, rounded


@query("impute_median", """SELECT SK_ID_CURR, round(coalesce(EXT_SOURCE_1, m1), 8) AS EXT_SOURCE_1,
  round(coalesce(SPARSE_B, m2), 8) AS SPARSE_B, round(coalesce(DAYS_EMPLOYED, m3), 8) AS DAYS_EMPLOYED FROM fixed,
  (SELECT median(EXT_SOURCE_1) AS m1, median(SPARSE_B) AS m2, quantile_cont(DAYS_EMPLOYED::DOUBLE, 0.5) AS m3 FROM fixed)""",
       {"fixed": S.FIXED})
def impute_median(spark, sf):
    cols = ["EXT_SOURCE_1", "SPARSE_B", "DAYS_EMPLOYED"]
    df = materialize(C.fix_sentinel(loans(spark, sf, ["SK_ID_CURR", *cols])))
    return rounded(C.impute(df, C.fit_medians(df, cols)), 8)


@query("impute_missing_label", """SELECT SK_ID_CURR, coalesce(NAME_EDUCATION_TYPE, 'MISSING') AS NAME_EDUCATION_TYPE
  FROM loans""")
def impute_missing_label(spark, sf):
    return C.impute(loans(spark, sf, ["SK_ID_CURR", "NAME_EDUCATION_TYPE"]), {}, ["NAME_EDUCATION_TYPE"])


_STR = ["NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"]


@query("cardinality_route", 'SELECT "column", k AS n_levels, CASE WHEN k > 10 THEN \'frequency\' ELSE \'one_hot\' END '
       "AS encoding FROM (" + " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", (count(DISTINCT {c}) + max(({c} IS NULL)::INT))::BIGINT AS k FROM loans"
           for c in _STR) + ")")
def cardinality_route(spark, sf):
    return C.route_cardinality(loans(spark, sf, _STR), _STR)


@query("frequency_encode", """SELECT SK_ID_CURR, (count(*) OVER (PARTITION BY OCCUPATION_TYPE))::DOUBLE AS OCCUPATION_TYPE
  FROM loans""")
def frequency_encode(spark, sf):
    return C.frequency_encode(loans(spark, sf, ["SK_ID_CURR", "OCCUPATION_TYPE"]), ["OCCUPATION_TYPE"])


@query("one_hot", "SELECT SK_ID_CURR, " + ", ".join(
    f"CASE WHEN NAME_INCOME_TYPE = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"NAME_INCOME_TYPE_{v}\""
    for v in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM loans")
def one_hot(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "NAME_INCOME_TYPE"])
    return C.one_hot(df, C.fit_encoding(df, ["NAME_INCOME_TYPE"]).one_hot)


@query("stratified_split", "SELECT SK_ID_CURR, TARGET, SPLIT FROM tagged", S.SPLIT_CTES)
def stratified_split(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return fit_stratified_split(df).transform(df, K.SPLIT)


@query("split_membership", "SELECT SK_ID_CURR, SPLIT, TARGET FROM tagged", S.SPLIT_CTES)
def split_membership_query(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return split_membership(df, fit_stratified_split(df))


@query("union_train_val", "SELECT SK_ID_CURR, TARGET FROM tagged WHERE SPLIT IN ('train', 'val')", S.SPLIT_CTES)
def union_train_val(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return only(fit_stratified_split(df).transform(df, K.SPLIT), "train", "val").drop(K.SPLIT)


@query("stratified_kfold", """SELECT SK_ID_CURR, TARGET, CAST(CASE
  WHEN rn <= (cn % 5) * (cn // 5 + 1) THEN (rn - 1) // (cn // 5 + 1)
  ELSE (cn % 5) + (rn - 1 - (cn % 5) * (cn // 5 + 1)) // (cn // 5) END AS VARCHAR) AS fold FROM ranked""",
       {"ranked": S.RANKED})
def stratified_kfold(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return fit_stratified_kfold(df, 5).transform(df, "fold")


@query("sample_n", """SELECT SK_ID_CURR, AMT_CREDIT FROM loans
  ORDER BY md5(concat('42:', CAST(SK_ID_CURR AS VARCHAR))), SK_ID_CURR LIMIT 5000""")
def sample_n(spark, sf):
    return sample_rows(loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT"]), 5000)


_SCALED = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "DAYS_BIRTH"]


@query("train_scaled", "SELECT SK_ID_CURR, SPLIT, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED) + " FROM tagged, (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + " FROM tagged WHERE SPLIT = 'train')", S.SPLIT_CTES)
def train_scaled(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", *_SCALED])
    tagged = fit_stratified_split(df).transform(df, K.SPLIT)
    out = fit_scaler(only(tagged, "train"), _SCALED).transform(tagged)
    return rounded(out.select("SK_ID_CURR", K.SPLIT, *_SCALED))


_INPUT = ["EXT_SOURCE_1", "EXT_SOURCE_3", "SPARSE_B"]


@query("train_median_impute", "SELECT SK_ID_CURR, SPLIT, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _INPUT) + " FROM filled, (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _INPUT) + " FROM filled WHERE SPLIT = 'train')", {
    **S.SPLIT_CTES,
    "med": "SELECT " + ", ".join(f"median({c}) AS d_{c}" for c in _INPUT) + " FROM tagged WHERE SPLIT = 'train'",
    "filled": "SELECT SK_ID_CURR, SPLIT, " + ", ".join(f"coalesce({c}, d_{c}) AS {c}" for c in _INPUT)
              + " FROM tagged, med"})
def train_median_impute(spark, sf):
    df = materialize(loans(spark, sf, ["SK_ID_CURR", "TARGET", *_INPUT]))
    tagged = fit_stratified_split(df).transform(df, K.SPLIT)
    out = fit_model_input(only(tagged, "train"), _INPUT).transform(tagged)
    return rounded(out.select("SK_ID_CURR", K.SPLIT, *_INPUT))


@query("class_weights", """SELECT n, n_pos, n - n_pos AS n_neg, round((n - n_pos) / n_pos, 6) AS scale_pos_weight,
  round(n / (2 * n_pos), 6) AS weight_pos, round(n / (2 * (n - n_pos)), 6) AS weight_neg
  FROM (SELECT count(*) AS n, sum(TARGET)::BIGINT AS n_pos FROM loans)""")
def class_weights_query(spark, sf):
    return rounded(class_weights(loans(spark, sf, ["TARGET"])))


# the whole pipeline: sentinel, drop SPARSE_A, fill, encode, split, scale
_NUM = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "DAYS_BIRTH",
        "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "SPARSE_B", "REGION_RATING_CLIENT"]
_HOT = {
    "NAME_INCOME_TYPE": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "NAME_EDUCATION_TYPE": ["Higher education", "Incomplete higher", "Lower secondary", "MISSING",
                            "Secondary / secondary special"],
}
_DUMMY = [f"{c}_{v}" for c, vs in _HOT.items() for v in vs]
_FEATURES = [*_NUM, "OCCUPATION_TYPE", *_DUMMY]
_PIPE = {
    "fixed": S.FIXED,
    "med": "SELECT " + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS d_{c}" for c in _NUM) + " FROM fixed",
    "enc": "SELECT SK_ID_CURR, TARGET, " + ", ".join(f"coalesce({c}::DOUBLE, d_{c}) AS {c}" for c in _NUM)
           + ", (count(*) OVER (PARTITION BY OCCUPATION_TYPE))::DOUBLE AS OCCUPATION_TYPE, "
           + ", ".join(f"CASE WHEN coalesce({c}, 'MISSING') = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\""
                       for c, vs in _HOT.items() for v in vs) + " FROM fixed, med",
    "ranked": S.RANKED.replace("FROM loans", "FROM enc"),
    "tagged": S.SPLIT,
    "stats": "SELECT " + ", ".join(
        f"avg(\"{c}\") AS m{i}, coalesce(nullif(stddev_pop(\"{c}\"), 0), 1) AS s{i}" for i, c in enumerate(_FEATURES))
        + " FROM tagged WHERE SPLIT = 'train'",
}


@query("clean_pipeline", "SELECT SK_ID_CURR, TARGET, SPLIT, " + ", ".join(
    f"round((\"{c}\" - m{i}) / s{i}, 6) AS \"{c}\"" for i, c in enumerate(_FEATURES)) + " FROM tagged, stats", _PIPE)
def clean_pipeline(spark, sf):
    return rounded(C.clean(materialize(loans(spark, sf)))[0])


@query("cleaning_summary", """SELECT metric, value::DOUBLE AS value FROM (
  SELECT 'rows_in' AS metric, count(*) AS value FROM loans UNION ALL SELECT 'cols_in', 18
  UNION ALL SELECT 'sentinel_replaced', count(*) FROM loans WHERE DAYS_EMPLOYED = 365243
  UNION ALL SELECT 'columns_dropped', 1 UNION ALL SELECT 'columns_filled', 8
  UNION ALL SELECT 'values_filled', sum((AMT_GOODS_PRICE IS NULL)::INT + (AMT_ANNUITY IS NULL)::INT
    + (DAYS_EMPLOYED IS NULL)::INT + (EXT_SOURCE_1 IS NULL)::INT + (EXT_SOURCE_2 IS NULL)::INT
    + (EXT_SOURCE_3 IS NULL)::INT + (SPARSE_B IS NULL)::INT + (NAME_EDUCATION_TYPE IS NULL)::INT) FROM fixed
  UNION ALL SELECT 'one_hot_columns', 2 UNION ALL SELECT 'frequency_columns', 1 UNION ALL SELECT 'feature_count', 22
  UNION ALL SELECT 'rows_' || SPLIT, count(*) FROM tagged GROUP BY SPLIT
  UNION ALL SELECT 'rows_out', count(*) FROM tagged UNION ALL SELECT 'cols_out', 25)""", _PIPE)
def cleaning_summary(spark, sf):
    spec = C.fit_cleaning(materialize(loans(spark, sf)))
    return spark.createDataFrame(spec.summary_rows(), "metric string, value double")


@query("clean_sanity", """SELECT "check", round(value::DOUBLE, 6) AS value FROM (SELECT 'nulls_left' AS "check", 0 AS value
  UNION ALL SELECT 'sentinels_left', 0 UNION ALL SELECT 'n_splits', count(DISTINCT SPLIT) FROM tagged
  UNION ALL SELECT 'max_abs_train_mean', 0)""", _PIPE)
def clean_sanity_query(spark, sf):
    cleaned, spec = C.clean(materialize(loans(spark, sf)))
    return rounded(clean_sanity(cleaned, list(spec.scaler.stats)))

