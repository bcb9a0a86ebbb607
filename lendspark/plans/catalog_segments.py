"""Queries: bins, segment rates, correlations and independence tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import bin_index, bin_midpoint
from ..operators import binning as B
from ..operators import segments as G
from ..operators import stats as T
from ..operators.cleaning import fix_sentinel
from ..operators.engineering import credit_to_income
from . import sqlparts as S
from .loans import loans
from .registry import query, rounded


def _band_sql(x: str, edges: list, labels: list, lowest: bool = True) -> str:
    """CASE over right-closed intervals."""
    first = f"WHEN {x} = {edges[0]} THEN '{labels[0]}' " if lowest else ""
    return "CASE " + first + " ".join(
        f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(edges, edges[1:], labels, strict=False)
    ) + " END"


_INCOME = _band_sql("least(greatest(AMT_INCOME_TOTAL, 25650), 117000000)", K.INCOME_EDGES, K.INCOME_LABELS)
_INCOME = f"CASE WHEN AMT_INCOME_TOTAL IS NOT NULL THEN {_INCOME} END"
_EMPLOYED = _band_sql("(-nullif(DAYS_EMPLOYED, 365243) / 365.25::DOUBLE)", K.EMPLOYMENT_EDGES, K.EMPLOYMENT_LABELS)
_DIMS = {"Income band (deciles)": _INCOME, "Employment length": _EMPLOYED, **{
    d: f"CAST({c} AS VARCHAR)" for d, c in K.SEGMENT_DIMENSIONS.items() if c not in ("AMT_INCOME_TOTAL", "DAYS_EMPLOYED")}}
_RATE = """n, round(p, 8) AS default_rate, round(greatest(p - 1.96 * sqrt(p * (1 - p) / n), 0), 8) AS ci_lo,
  round(least(p + 1.96 * sqrt(p * (1 - p) / n), 1), 8) AS ci_hi"""
_EXACT = """n, round(p, 8) AS default_rate, round(p - 1.959963984540054 * sqrt(p * (1 - p) / n), 8) AS ci_lo,
  round(p + 1.959963984540054 * sqrt(p * (1 - p) / n), 8) AS ci_hi"""


def _grouped(seg: str, source: str = "loans") -> str:
    return f"SELECT {seg} AS segment, count(*) AS n, sum(TARGET)::DOUBLE / count(*) AS p FROM {source} GROUP BY 1"


@query("segment_default_rate", f"SELECT segment, {_RATE} FROM g WHERE n >= 100", {"g": _grouped(_INCOME)})
def segment_default_rate(spark, sf):
    df = loans(spark, sf, ["TARGET", "AMT_INCOME_TOTAL"])
    return rounded(G.default_rate_by_segment(df, B.income_band()), 8)


@query("segments_all_dims", f"SELECT dimension, segment, {_RATE} FROM ("
       "SELECT dimension, segment, count(*) AS n, sum(TARGET)::DOUBLE / count(*) AS p FROM long GROUP BY ALL) WHERE n >= 100",
       {"long": " UNION ALL ".join(f"SELECT '{d}' AS dimension, {e} AS segment, TARGET FROM loans" for d, e in _DIMS.items())})
def segments_all_dims(spark, sf):
    cols = ["TARGET", *K.SEGMENT_DIMENSIONS.values()]
    return rounded(G.segments_all_dimensions(loans(spark, sf, cols)), 8)


@query("segment_by_region", f"SELECT segment, {_RATE} FROM g WHERE n >= 100",
       {"g": _grouped("NAME_INCOME_TYPE", "loans WHERE REGION_RATING_CLIENT IN (1, 2)")})
def segment_by_region(spark, sf):
    df = G.region_filter(loans(spark, sf, ["TARGET", "NAME_INCOME_TYPE", "REGION_RATING_CLIENT"]), [1, 2])
    return rounded(G.default_rate_by_segment(df, "NAME_INCOME_TYPE"), 8)


@query("segment_export", """SELECT segment AS "Segment", n AS "Applicants", default_rate AS "Default rate",
  ci_lo AS "95% CI low", ci_hi AS "95% CI high" FROM (SELECT segment, """ + _RATE + " FROM g WHERE n >= 100)",
       {"g": _grouped("NAME_EDUCATION_TYPE")})
def segment_export(spark, sf):
    rates = rounded(G.default_rate_by_segment(loans(spark, sf, ["TARGET", "NAME_EDUCATION_TYPE"]), "NAME_EDUCATION_TYPE"), 8)
    return G.segment_export(rates)


@query("top_risk_segments", f"SELECT segment, {_EXACT} FROM g ORDER BY p DESC, segment LIMIT 5",
       {"g": _grouped("OCCUPATION_TYPE")})
def top_risk_segments(spark, sf):
    df = loans(spark, sf, ["TARGET", "OCCUPATION_TYPE"]).withColumnRenamed("OCCUPATION_TYPE", "segment")
    return rounded(G.top_risk(G.rate_by(df, ["segment"], z=K.Z_EXACT, clipped=False), 5, "segment"), 8)


@query("portfolio_kpis", """SELECT count(*) AS n, sum(TARGET)::BIGINT AS defaults, round(avg(TARGET), 8) AS default_rate,
  round(1 - avg(TARGET), 8) AS repaid_share, round(avg(SCORE), 8) AS mean_score FROM tagged WHERE SPLIT = 'train'""", S.SPLIT_CTES)
def portfolio_kpis(spark, sf):
    from ..operators.splitting import fit_stratified_split, only

    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", "SCORE"])
    return rounded(G.portfolio_kpis(only(fit_stratified_split(df).transform(df, K.SPLIT), "train"), "SCORE"), 8)


@query("employment_buckets", f"SELECT SK_ID_CURR, {_EMPLOYED} AS bucket FROM loans")
def employment_buckets(spark, sf):
    return loans(spark, sf, ["SK_ID_CURR", "DAYS_EMPLOYED"]).select("SK_ID_CURR", B.employment_bucket().alias("bucket"))


@query("income_band", f"SELECT SK_ID_CURR, {_INCOME} AS band FROM loans")
def income_band(spark, sf):
    return loans(spark, sf, ["SK_ID_CURR", "AMT_INCOME_TOTAL"]).select("SK_ID_CURR", B.income_band().alias("band"))


@query("employment_rate", f"SELECT segment, {_EXACT} FROM g WHERE segment IS NOT NULL", {"g": _grouped(_EMPLOYED)})
def employment_rate(spark, sf):
    df = loans(spark, sf, ["TARGET", "DAYS_EMPLOYED"]).select("TARGET", B.employment_bucket(include_lowest=False).alias("segment"))
    return rounded(G.rate_by(df.where("segment IS NOT NULL"), ["segment"], z=K.Z_EXACT, clipped=False), 8)


_CTI = "SELECT *, AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS CTI FROM loans"
_CTI_CTES = {"cti": _CTI, "e": f"SELECT {S.edge_list('CTI', 10)} AS edges FROM cti",
             "binned": f"SELECT cti.*, edges, {S.edge_bin('CTI', 'edges')} AS bin FROM cti, e"}


@query("quantile_bins", """SELECT SK_ID_CURR, bin::INT AS bin, round(edges[bin + 1], 6) AS bin_lo,
  round(edges[bin + 2], 6) AS bin_hi FROM binned""", _CTI_CTES)
def quantile_bins(spark, sf):
    df = credit_to_income(loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL"]))
    return rounded(B.quantile_bin(df, "CTI", 10, decimals=9).select("SK_ID_CURR", "bin", "bin_lo", "bin_hi"))


@query("cti_decile_rate", f"SELECT bin, bin_mid, {_EXACT} FROM g", {**_CTI_CTES, "g": """SELECT bin::INT AS bin,
  round((edges[bin + 1] + edges[bin + 2]) / 2, 6) AS bin_mid, count(*) AS n, avg(TARGET) AS p FROM binned
  WHERE bin IS NOT NULL GROUP BY 1, 2"""})
def cti_decile_rate(spark, sf):
    df = credit_to_income(loans(spark, sf, ["TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL"]))
    edges = B.fit_quantile_edges(df, "CTI", 10, decimals=9)
    binned = df.withColumn("bin", bin_index(F.col("CTI"), edges)).where("bin IS NOT NULL")
    rates = G.rate_by(binned, ["bin"], z=K.Z_EXACT, clipped=False)
    return rounded(rates.withColumn("bin_mid", F.round(bin_midpoint(F.col("bin"), edges), 6)), 8)


@query("income_decile_rate", f"SELECT bin, {_EXACT} FROM g", {
    "e": f"SELECT {S.edge_list('AMT_INCOME_TOTAL', 10)} AS edges FROM loans",
    "g": f"""SELECT ({S.edge_bin('AMT_INCOME_TOTAL', 'edges')})::INT AS bin, count(*) AS n, avg(TARGET) AS p FROM loans, e
      GROUP BY 1 HAVING bin IS NOT NULL"""})
def income_decile_rate(spark, sf):
    df = loans(spark, sf, ["TARGET", "AMT_INCOME_TOTAL"])
    binned = B.quantile_bin(df, "AMT_INCOME_TOTAL", 10, decimals=9).where("bin IS NOT NULL")
    return rounded(G.rate_by(binned, ["bin"], z=K.Z_EXACT, clipped=False), 8)


@query("income_by_cti", """SELECT bin::INT AS bin, count(*) AS n, round(avg(AMT_INCOME_TOTAL), 4) AS mean_value FROM binned
  WHERE bin IS NOT NULL GROUP BY 1""", _CTI_CTES)
def income_by_cti(spark, sf):
    df = credit_to_income(loans(spark, sf, ["AMT_CREDIT", "AMT_INCOME_TOTAL"]))
    return rounded(G.mean_by(B.quantile_bin(df, "CTI", 10, decimals=9).where("bin IS NOT NULL"), "bin", "AMT_INCOME_TOTAL"), 4)


@query("quantile_bins_by_group", """SELECT NAME_CONTRACT_TYPE, bin, n, round(p, 8) AS default_rate,
  round(p - 1.959963984540054 * sqrt(p * (1 - p) / n), 8) AS ci_lo, round(p + 1.959963984540054 * sqrt(p * (1 - p) / n), 8)
  AS ci_hi FROM g""", {
    "cti": _CTI, "e": f"SELECT NAME_CONTRACT_TYPE AS k, {S.edge_list('CTI', 10)} AS edges FROM cti GROUP BY 1",
    "g": f"""SELECT NAME_CONTRACT_TYPE, ({S.edge_bin('CTI', 'edges')})::INT AS bin, count(*) AS n, avg(TARGET) AS p
      FROM cti JOIN e ON k = NAME_CONTRACT_TYPE GROUP BY 1, 2 HAVING bin IS NOT NULL"""})
def quantile_bins_by_group(spark, sf):
    df = credit_to_income(loans(spark, sf, ["TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "NAME_CONTRACT_TYPE"]))
    binned = B.quantile_bin_by_group(df, "CTI", "NAME_CONTRACT_TYPE", 10, decimals=9).where("bin IS NOT NULL")
    return rounded(G.rate_by(binned, ["NAME_CONTRACT_TYPE", "bin"], z=K.Z_EXACT, clipped=False), 8)


_HIST = """SELECT bin, round(lo + bin * (hi - lo) / 50, 6) AS lo, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS hi, n FROM (
  SELECT b.bin, count(v.x) AS n FROM (SELECT unnest(range(50))::INT AS bin) b LEFT JOIN (
    SELECT least(floor((x - lo) / ((hi - lo) / 50)), 49)::INT AS bin, x FROM vals, ends) v USING (bin) GROUP BY 1), ends"""


@query("log_histogram", _HIST, {
    "vals": "SELECT round(log10(AMT_CREDIT), 9) AS x FROM loans WHERE AMT_CREDIT > 0",
    "ends": "SELECT min(x) AS lo, max(x) AS hi FROM vals"})
def log_histogram(spark, sf):
    return rounded(B.histogram(loans(spark, sf, ["AMT_CREDIT"]), "AMT_CREDIT", 50, log10=True, decimals=9))


@query("capped_histogram", _HIST, {
    "top": "SELECT round(quantile_cont(AMT_ANNUITY, 0.99), 4) AS t FROM loans",
    "vals": "SELECT least(AMT_ANNUITY, t) AS x FROM loans, top WHERE AMT_ANNUITY IS NOT NULL",
    "ends": "SELECT min(x) AS lo, max(x) AS hi FROM vals"})
def capped_histogram(spark, sf):
    df = loans(spark, sf, ["AMT_ANNUITY"])
    return rounded(B.histogram(df, "AMT_ANNUITY", 50, cap_quantile=0.99, decimals=4))


@query("kde_by_class", """SELECT g.TARGET, p.point, round(lo + point * (hi - lo) / 199, 6) AS x,
  round(sum(w * exp(-pow((lo + point * (hi - lo) / 199 - v) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
  AS density FROM weights g JOIN band USING (TARGET), ends, (SELECT unnest(range(200))::INT AS point) p
  GROUP BY g.TARGET, p.point, lo, hi""", {
    "weights": "SELECT TARGET, EXT_SOURCE_3 AS v, count(*) AS w FROM loans WHERE EXT_SOURCE_3 IS NOT NULL GROUP BY ALL",
    "band": """SELECT TARGET, count(*) AS n, stddev_samp(EXT_SOURCE_3) * pow(count(*), -0.2) AS h FROM loans
      WHERE EXT_SOURCE_3 IS NOT NULL GROUP BY 1""",
    "ends": "SELECT min(EXT_SOURCE_3) AS lo, max(EXT_SOURCE_3) AS hi FROM loans"})
def kde_by_class(spark, sf):
    return rounded(B.kde(loans(spark, sf, ["TARGET", "EXT_SOURCE_3"]), "EXT_SOURCE_3", "TARGET", 200))


@query("kde_binned_by_class", """SELECT g.TARGET, g.point, round(x, 6) AS x, round(coalesce(sum(w * exp(-pow((x - m) / g.h, 2) / 2))
    / (g.n * g.h * sqrt(2 * pi())), 0), 8) AS density
  FROM (SELECT band.*, point, lo + point * (hi - lo) / 199 AS x FROM band, ends, (SELECT unnest(range(200))::INT AS point)) g
  LEFT JOIN cells c ON c.TARGET = g.TARGET AND c.m BETWEEN x - reach AND x + reach GROUP BY g.TARGET, g.point, x, g.n, g.h""", {
    "vals": "SELECT TARGET, AMT_CREDIT::DOUBLE / 1000 AS v FROM loans WHERE AMT_CREDIT IS NOT NULL AND TARGET IS NOT NULL",
    "band": """SELECT TARGET, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, stddev_samp(v) * pow(count(*), -0.2) * sqrt(8e-6) AS d,
      stddev_samp(v) * pow(count(*), -0.2) * sqrt(-2 * ln(1e-6)) AS reach FROM vals GROUP BY 1""",
    "ends": "SELECT min(v) AS lo, max(v) AS hi FROM vals",
    "placed": "SELECT TARGET, floor((v - lo) / d) AS c, (v - lo) / d - floor((v - lo) / d) AS t, lo, d FROM vals JOIN band USING (TARGET), ends",
    "cells": """SELECT TARGET, any_value(lo) + c * any_value(d) AS m, sum(w) AS w FROM (SELECT TARGET, c, 1 - t AS w, lo, d FROM placed
      UNION ALL SELECT TARGET, c + 1, t, lo, d FROM placed) GROUP BY TARGET, c"""})
def kde_binned_by_class(spark, sf):
    """Credit amounts in thousands, a column with nearly as many values as rows."""
    df = loans(spark, sf, ["TARGET", "AMT_CREDIT"]).withColumn("v", F.col("AMT_CREDIT").cast("double") / 1000)
    return rounded(B.kde_binned(df, "v", "TARGET", 200), density=8)


_CORR = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED",
         "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "SPARSE_B", "REGION_RATING_CLIENT", "SCORE"]
_PEARSON = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, corr({c}, TARGET) AS r FROM fixed" for c in _CORR)


@query("pearson_target", """SELECT feature, n, round(r, 8) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t FROM (
  """ + _PEARSON + ")", {"fixed": S.FIXED})
def pearson_target(spark, sf):
    df = fix_sentinel(loans(spark, sf, ["TARGET", *_CORR]))
    return rounded(T.pearson_target(df, _CORR).drop("log10_p"), r=8)


@query("pearson_p_values")
def pearson_p_values(spark, sf):
    return T.pearson_target(fix_sentinel(loans(spark, sf, ["TARGET", *_CORR])), _CORR)


@query("top_correlated", f"SELECT feature, n, round(r, 8) AS r FROM ({_PEARSON}) ORDER BY abs(r) DESC, feature LIMIT 5",
       {"fixed": S.FIXED})
def top_correlated(spark, sf):
    df = fix_sentinel(loans(spark, sf, ["TARGET", *_CORR]))
    return rounded(T.top_correlated(df, _CORR, 5).select("feature", "n", "r"), 8)


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, corr({a}, {b}) AS r "
    "FROM fixed" for i, a in enumerate(_CORR) for b in _CORR[i + 1:])


@query("corr_matrix", f"SELECT a, b, n, round(r, 8) AS r FROM ({_PAIRS})", {"fixed": S.FIXED})
def corr_matrix(spark, sf):
    df = fix_sentinel(loans(spark, sf, _CORR))
    return rounded(T.correlation_matrix(df, _CORR).drop("i", "j"), 8)


@query("collinear_pairs", f"SELECT a, b, round(r, 8) AS r FROM ({_PAIRS}) WHERE abs(r) > 0.5", {"fixed": S.FIXED})
def collinear_pairs(spark, sf):
    df = fix_sentinel(loans(spark, sf, _CORR))
    return rounded(T.collinear_pairs(T.correlation_matrix(df, _CORR), 0.5), 8)


@query("crosstab", """SELECT NAME_INCOME_TYPE AS level, count(*) FILTER (WHERE TARGET = 0) AS n0,
  count(*) FILTER (WHERE TARGET = 1) AS n1 FROM loans GROUP BY 1""")
def crosstab(spark, sf):
    return T.crosstab(loans(spark, sf, ["NAME_INCOME_TYPE", "TARGET"]), "NAME_INCOME_TYPE")


_CATS = ["NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE"]
_CHI = {
    "long": " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS level, TARGET AS y FROM loans WHERE {c} IS NOT NULL" for c in _CATS),
    "obs": """SELECT feature, level, y, count(*)::DOUBLE AS o FROM long GROUP BY ALL""",
    "filled": """SELECT l.feature, l.level, t.y, coalesce(o, 0) AS o FROM (SELECT DISTINCT feature, level FROM obs) l
      CROSS JOIN (SELECT unnest([0, 1]) AS y) t LEFT JOIN obs USING (feature, level, y)""",
    "ex": """SELECT *, sum(o) OVER (PARTITION BY feature, level) * sum(o) OVER (PARTITION BY feature, y)
      / sum(o) OVER (PARTITION BY feature) AS e, count(DISTINCT level) OVER (PARTITION BY feature) AS levels FROM filled""",
    "chi": """SELECT feature, sum(o)::BIGINT AS n, any_value(levels) AS levels, any_value(levels) - 1 AS dof,
      sum(CASE WHEN levels = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS chi2
      FROM ex GROUP BY feature"""}


@query("chi_square", "SELECT feature, n, levels, dof, round(chi2, 6) AS chi2 FROM chi", _CHI)
def chi_square(spark, sf):
    return rounded(T.chi_square(loans(spark, sf, ["TARGET", *_CATS]), _CATS).select("feature", "n", "levels", "dof", "chi2"))


@query("cramers_v", "SELECT feature, round(sqrt(chi2 / n), 8) AS cramers_v FROM chi", _CHI)
def cramers_v(spark, sf):
    return rounded(T.chi_square(loans(spark, sf, ["TARGET", *_CATS]), _CATS).select("feature", "cramers_v"), 8)


@query("chi_square_p_values")
def chi_square_p_values(spark, sf):
    return T.chi_square(loans(spark, sf, ["TARGET", *_CATS]), _CATS)
