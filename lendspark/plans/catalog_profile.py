"""Queries: source audits, profiles, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import drift_verdict, feature_family, map_values, policy_band, row_mean, safe_divide, years_from_days
from ..functions import clip, sentinel_to_null
from ..operators import profiling as P
from ..operators.cleaning import fit_sparse_columns, fix_sentinel
from ..operators.engineering import REQUIRED, credit_to_income, engineer_features, standardized
from ..operators.segments import region_filter
from ..operators.splitting import fit_stratified_split, only
from ..session import materialize
from ..sources import audits as A
from . import sqlparts as S
from .loans import APPLICATION, COLUMNS, NUMERIC, loans, table
from .registry import query, rounded

_STR = ["NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"]


@query("shape_contract", "SELECT count(*)::BIGINT AS n_rows, 18::BIGINT AS n_cols FROM loans")
def shape_contract(spark, sf):
    df = loans(spark, sf)
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


@query("overview_projection", "SELECT TARGET, SPLIT, count(*) AS n FROM tagged GROUP BY ALL", S.SPLIT_CTES)
def overview_projection(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return fit_stratified_split(df).transform(df, K.SPLIT).groupBy(K.TARGET, K.SPLIT).agg(F.count("*").alias("n"))


@query("embedded_newlines", """SELECT count(*) AS n_rows, count(*) FILTER (WHERE contains(text, chr(10))) AS n_embedded,
  sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS n_newlines FROM documents""", book=False)
def embedded_newlines(spark, sf):
    return A.embedded_newlines(table(spark, sf, "documents"), "text")


@query("quote_parity", """SELECT sum(length(html) - length(replace(html, '"', '')))::BIGINT AS n_quotes,
  (sum(length(html) - length(replace(html, '"', ''))) % 2)::BIGINT AS parity,
  count(*) FILTER (WHERE (length(html) - length(replace(html, '"', ''))) % 2 = 1) AS n_odd_rows FROM pages""", book=False)
def quote_parity(spark, sf):
    return A.quote_parity(table(spark, sf, "pages"), "html")


@query("id_gaps", """SELECT id, next_id, next_id - id - 1 AS n_missing FROM (
  SELECT doc_id AS id, lead(doc_id) OVER (ORDER BY doc_id) AS next_id FROM (SELECT DISTINCT doc_id FROM labels))
  WHERE next_id - id > 1""", book=False)
def id_gaps(spark, sf):
    return A.id_gaps(table(spark, sf, "labels"), "doc_id")


@query("missing_ids", """SELECT r.id FROM (SELECT unnest(range(lo, hi + 1)) AS id FROM (
  SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM documents)) r WHERE r.id NOT IN (SELECT doc_id FROM labels)""", book=False)
def missing_ids(spark, sf):
    ends = table(spark, sf, "documents").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    return A.missing_ids(table(spark, sf, "labels"), "doc_id", ends.lo, ends.hi)


@query("missing_id_ranges", """SELECT id + 1 AS first, nx - 1 AS last, nx - id - 1 AS n_missing FROM (
  SELECT id, lead(id) OVER (ORDER BY id) AS nx FROM (SELECT DISTINCT doc_id AS id FROM labels)) WHERE nx - id > 1""", book=False)
def missing_id_ranges(spark, sf):
    return A.missing_ranges(table(spark, sf, "labels"), "doc_id")


_MISSING = {"prof": " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(({c} IS NULL)::INT) AS missing_frac FROM loans" for c in APPLICATION)}


@query("missing_profile", 'SELECT "column", round(missing_frac, 8) AS missing_frac FROM prof', _MISSING)
def missing_profile(spark, sf):
    return rounded(P.missing_profile(loans(spark, sf)), 8)


@query("high_missing", 'SELECT "column", round(missing_frac, 8) AS missing_frac FROM prof WHERE missing_frac > 0.6', _MISSING)
def high_missing(spark, sf):
    return rounded(P.high_missing(loans(spark, sf)), 8)


@query("missing_top_k", """SELECT "column", round(missing_frac, 8) AS missing_frac, rank FROM (SELECT *,
  row_number() OVER (ORDER BY missing_frac DESC, "column")::INT AS rank FROM prof) WHERE rank <= 5""", _MISSING)
def missing_top_k(spark, sf):
    return rounded(P.missing_top_k(loans(spark, sf), 5), 8)


@query("class_balance", """SELECT TARGET, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM loans
  GROUP BY TARGET""")
def class_balance(spark, sf):
    return rounded(P.class_balance(loans(spark, sf, ["TARGET"])), 8)


@query("split_counts", "SELECT SPLIT, count(*) AS n FROM tagged GROUP BY SPLIT", S.SPLIT_CTES)
def split_counts(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return P.value_counts(fit_stratified_split(df).transform(df, K.SPLIT), K.SPLIT)


@query("split_rates", "SELECT SPLIT, count(*) AS n, round(avg(TARGET), 8) AS positive_rate FROM tagged GROUP BY SPLIT",
       S.SPLIT_CTES)
def split_rates(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET"])
    return rounded(P.split_rates(fit_stratified_split(df).transform(df, K.SPLIT)), 8)


@query("describe_features", """SELECT feature, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
  min(x) AS min, round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS median,
  round(quantile_cont(x, 0.75), 4) AS p75, max(x) AS max FROM long GROUP BY feature""",
       {"long": S.unpivot("loans", ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "DAYS_BIRTH", "CNT_FAM_MEMBERS"])})
def describe_features(spark, sf):
    cols = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "DAYS_BIRTH", "CNT_FAM_MEMBERS"]
    return rounded(P.describe(materialize(loans(spark, sf, cols)), cols), 4)


@query("engineered_nulls", """SELECT "column", n_null, round(n_null / n, 8) AS null_share FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n FROM eng" for c in K.ENGINEERED) + ")",
       {"fixed": S.FIXED, "eng": S.ENGINEERED.format(source="fixed")})
def engineered_nulls(spark, sf):
    eng = engineer_features(fix_sentinel(loans(spark, sf, REQUIRED)))
    return rounded(P.null_counts(eng, K.ENGINEERED), 8)


@query("column_medians", """SELECT feature AS "column", round(quantile_cont(x, 0.5), 5) AS median, min(x) AS min, max(x) AS max
  FROM long GROUP BY feature""", {"long": S.unpivot("loans", ["AMT_CREDIT", "AMT_ANNUITY", "DAYS_EMPLOYED"])})
def column_medians(spark, sf):
    cols = ["AMT_CREDIT", "AMT_ANNUITY", "DAYS_EMPLOYED"]
    return rounded(P.column_summary(materialize(loans(spark, sf, cols)), cols), 5)


_CARD = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (count(DISTINCT {c}) + max(({c} IS NULL)::INT))::BIGINT AS k FROM loans"
    for c in _STR)


@query("cardinality", f'SELECT "column", k AS n_distinct FROM ({_CARD})')
def cardinality(spark, sf):
    return P.cardinality(loans(spark, sf, _STR), _STR)


@query("distinct_values", "SELECT DISTINCT OCCUPATION_TYPE FROM loans WHERE OCCUPATION_TYPE IS NOT NULL")
def distinct_values(spark, sf):
    return P.distinct_sorted(loans(spark, sf, ["OCCUPATION_TYPE"]), "OCCUPATION_TYPE")


@query("sentinel_fix", """SELECT count(*) FILTER (WHERE DAYS_EMPLOYED = 365243) AS n_replaced,
  count(nullif(DAYS_EMPLOYED, 365243)) AS n_left, min(nullif(DAYS_EMPLOYED, 365243)) AS min_left,
  max(nullif(DAYS_EMPLOYED, 365243)) AS max_left FROM loans""")
def sentinel_fix(spark, sf):
    df = loans(spark, sf, ["DAYS_EMPLOYED"])
    left = sentinel_to_null("DAYS_EMPLOYED")
    return df.agg(
        F.count_if(F.col("DAYS_EMPLOYED") == K.EMPLOYED_SENTINEL).alias("n_replaced"), F.count(left).alias("n_left"),
        F.min(left).alias("min_left"), F.max(left).alias("max_left"),
    )


@query("drop_sparse", "SELECT SK_ID_CURR, SPARSE_B, AMT_CREDIT FROM loans")
def drop_sparse(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "SPARSE_A", "SPARSE_B", "AMT_CREDIT"])
    return df.drop(*fit_sparse_columns(df))


@query("train_slice", "SELECT SK_ID_CURR, TARGET, AMT_CREDIT FROM tagged WHERE SPLIT = 'train'", S.SPLIT_CTES)
def train_slice(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", "AMT_CREDIT"])
    return only(fit_stratified_split(df).transform(df, K.SPLIT), "train").drop(K.SPLIT)


@query("region_filter", """SELECT REGION_RATING_CLIENT, count(*) AS n, sum(TARGET)::BIGINT AS defaults FROM loans
  WHERE REGION_RATING_CLIENT IN (1, 3) GROUP BY ALL""")
def region_filter_query(spark, sf):
    df = region_filter(loans(spark, sf, ["REGION_RATING_CLIENT", "TARGET"]), [1, 3])
    return df.groupBy("REGION_RATING_CLIENT").agg(F.count("*").alias("n"), F.sum("TARGET").alias("defaults"))


@query("positive_rows", """SELECT count(*) AS n, round(sum(AMT_INCOME_TOTAL), 2) AS total FROM loans
  WHERE AMT_INCOME_TOTAL > 0 AND EXT_SOURCE_1 IS NOT NULL AND EXT_SOURCE_3 IS NOT NULL""")
def positive_rows(spark, sf):
    df = loans(spark, sf, ["AMT_INCOME_TOTAL", "EXT_SOURCE_1", "EXT_SOURCE_3"])
    kept = df.dropna(subset=["EXT_SOURCE_1", "EXT_SOURCE_3"]).where("AMT_INCOME_TOTAL > 0")
    return rounded(kept.agg(F.count("*").alias("n"), F.sum("AMT_INCOME_TOTAL").alias("total")), 2)


@query("employment_years", """SELECT SK_ID_CURR, round(greatest(-DAYS_EMPLOYED / 365.25::DOUBLE, 0), 6) AS years FROM loans
  WHERE DAYS_EMPLOYED <> 365243""")
def employment_years(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "DAYS_EMPLOYED"]).where(F.col("DAYS_EMPLOYED") != K.EMPLOYED_SENTINEL)
    return rounded(df.select("SK_ID_CURR", clip(years_from_days("DAYS_EMPLOYED"), lo=0.0).alias("years")))


@query("safe_ratios", """SELECT SK_ID_CURR, round(CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_CREDIT / AMT_INCOME_TOTAL END, 6)
  AS credit_income, round(CASE WHEN CNT_FAM_MEMBERS > 0 THEN AMT_INCOME_TOTAL / CNT_FAM_MEMBERS END, 6) AS per_member
  FROM loans""")
def safe_ratios(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"])
    return rounded(df.select(
        "SK_ID_CURR", safe_divide("AMT_CREDIT", "AMT_INCOME_TOTAL").alias("credit_income"),
        safe_divide("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS").alias("per_member"),
    ))


@query("years_from_days", "SELECT SK_ID_CURR, round(-DAYS_BIRTH / 365.25::DOUBLE, 6) AS age_years FROM loans")
def years_from_days_query(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "DAYS_BIRTH"])
    return rounded(df.select("SK_ID_CURR", years_from_days("DAYS_BIRTH").alias("age_years")))


@query("partial_mean", "SELECT SK_ID_CURR, round(EXT_SOURCE_MEAN, 8) AS ext_mean FROM eng",
       {"eng": S.ENGINEERED.format(source="loans")})
def partial_mean(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"])
    return rounded(df.select("SK_ID_CURR", row_mean("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3").alias("ext_mean")), 8)


@query("engineer_features", "SELECT SK_ID_CURR, " + ", ".join(
    f"round({c}, 8) AS {c}" if c.endswith("MEAN") else f"round({c}, 6) AS {c}" for c in K.ENGINEERED) + " FROM eng",
       {"fixed": S.FIXED, "eng": S.ENGINEERED.format(source="fixed")})
def engineer_features_query(spark, sf):
    eng = engineer_features(fix_sentinel(loans(spark, sf, ["SK_ID_CURR", *REQUIRED])))
    return rounded(eng.select("SK_ID_CURR", *K.ENGINEERED), EXT_SOURCE_MEAN=8)


@query("cti_ratio", "SELECT SK_ID_CURR, round(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0), 6) AS CTI FROM loans")
def cti_ratio(spark, sf):
    df = credit_to_income(loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL"]))
    return rounded(df.select("SK_ID_CURR", "CTI"))


@query("cti_zscore", """SELECT SK_ID_CURR, round((cti - m) / s, 6) AS CTI_C, round(pow((cti - m) / s, 2), 6) AS CTI_C2 FROM
  (SELECT SK_ID_CURR, AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS cti FROM loans),
  (SELECT avg(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)) AS m, stddev_samp(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)) AS s
   FROM loans)""")
def cti_zscore(spark, sf):
    df = credit_to_income(loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL"]))
    return rounded(standardized(df, "CTI", "CTI_C").select("SK_ID_CURR", "CTI_C", "CTI_C2"))


@query("policy_bands", """SELECT SK_ID_CURR, SCORE, CASE WHEN SCORE < 0.2 THEN 'Approve' WHEN SCORE >= 0.5 THEN 'Reject'
  ELSE 'Manual Review' END AS recommendation FROM loans""")
def policy_bands(spark, sf):
    return loans(spark, sf, ["SK_ID_CURR", "SCORE"]).withColumn("recommendation", policy_band("SCORE"))


@query("drift_verdicts", """SELECT SK_ID_CURR, CASE WHEN SCORE < 0.1 THEN 'no_drift' WHEN SCORE < 0.25 THEN 'moderate_drift'
  ELSE 'major_drift' END AS verdict FROM loans""")
def drift_verdicts(spark, sf):
    return loans(spark, sf, ["SK_ID_CURR", "SCORE"]).select("SK_ID_CURR", drift_verdict("SCORE").alias("verdict"))


@query("feature_family", """SELECT feature, CASE WHEN starts_with(feature, 'EXT_SOURCE') THEN 'EXT_SOURCE'
  WHEN starts_with(feature, 'DAYS_') OR feature IN ('AGE_YEARS', 'EMPLOYED_YEARS') THEN 'Time-derived'
  WHEN starts_with(feature, 'NAME_') OR starts_with(feature, 'CODE_') OR starts_with(feature, 'FLAG_') THEN 'One-hot / flag'
  WHEN contains(feature, 'RATIO') OR contains(feature, 'INCOME') THEN 'Ratio'
  WHEN starts_with(feature, 'AMT_') THEN 'Amount'
  WHEN contains(feature, 'AREA') OR contains(feature, 'LIVING') THEN 'Area' ELSE 'Other' END AS family, n_null
  FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM loans" for c in COLUMNS) + ")")
def feature_family_query(spark, sf):
    nulls = P.null_counts(loans(spark, sf, list(COLUMNS)), list(COLUMNS))
    return nulls.select(F.col("column").alias("feature"), feature_family("column").alias("family"), "n_null")


@query("value_map", """SELECT SK_ID_CURR, CASE WHEN NAME_EDUCATION_TYPE IN ('Higher education', 'Academic degree')
  THEN 'NAME_EDUCATION_TYPE_Higher education' WHEN NAME_EDUCATION_TYPE IS NOT NULL
  THEN 'NAME_EDUCATION_TYPE_Secondary / secondary special' END AS indicator FROM loans""")
def value_map(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "NAME_EDUCATION_TYPE"])
    return df.select("SK_ID_CURR", map_values("NAME_EDUCATION_TYPE", K.EDUCATION_INDICATOR).alias("indicator"))


@query("numeric_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null, round(avg({c}::DOUBLE), 6) AS mean FROM loans" for c in NUMERIC))
def numeric_columns_query(spark, sf):
    from ..operators.guards import numeric_columns

    df = loans(spark, sf)
    names = numeric_columns(df, K.NON_FEATURES)
    return df.select(*names).agg(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.count_if(F.col(c).isNull()).alias("n_null"), F.round(F.avg(F.col(c).cast("double")), 6).alias("mean")
    ) for c in names]).alias("rows")).select(F.inline("rows"))
