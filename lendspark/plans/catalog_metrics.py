"""Queries: threshold metrics, curves, drift, ranking and policy mix on given scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import policy_band
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import scoring as R
from ..operators import selection as L
from ..operators.cleaning import fix_sentinel
from ..operators.engineering import REQUIRED, engineer_features
from ..operators.splitting import fit_stratified_split
from ..operators.stats import pearson_target
from ..session import materialize, split_wide_projections
from . import sqlparts as S
from .loans import BACKGROUND, loans, table
from .registry import query, rounded

# two scorers in long form: the book's score and one read off the first external rating
_TWO = {**S.SPLIT_CTES, "two": """SELECT 'policy' AS model, SPLIT, TARGET, SCORE AS score FROM tagged
  UNION ALL SELECT 'rating', SPLIT, TARGET, round(1 - EXT_SOURCE_3, 6) FROM tagged WHERE EXT_SOURCE_3 IS NOT NULL"""}
_COUNTS = """SELECT model, SPLIT, count(*) FILTER (WHERE score < 0.5 AND TARGET = 0) AS tn,
  count(*) FILTER (WHERE score >= 0.5 AND TARGET = 0) AS fp, count(*) FILTER (WHERE score < 0.5 AND TARGET = 1) AS fn,
  count(*) FILTER (WHERE score >= 0.5 AND TARGET = 1) AS tp FROM two GROUP BY ALL"""
_RATIOS = """SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
  (tn + tp) / (tn + fp + fn + tp) AS accuracy FROM counts"""
_STEPS = """SELECT *, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER (PARTITION BY model, SPLIT) AS pos,
  sum(q) OVER (PARTITION BY model, SPLIT) AS neg FROM (
    SELECT model, SPLIT, score, count(*) FILTER (WHERE TARGET = 1) AS p, count(*) FILTER (WHERE TARGET = 0) AS q
    FROM two GROUP BY ALL) WINDOW w AS (PARTITION BY model, SPLIT ORDER BY score DESC)"""
_AREA = """SELECT model, SPLIT, sum(q * (tp - p + p / 2)) / (any_value(pos) * any_value(neg)) AS roc_auc,
  sum(p / pos * (tp / (tp + fp) + CASE WHEN tp - p + fp - q > 0 THEN (tp - p) / (tp - p + fp - q) ELSE 1 END) / 2)
  AS pr_auc FROM steps GROUP BY ALL"""
_CURVES = {**_TWO, "steps": _STEPS}
_BY = ["model", K.SPLIT]


def two_scores(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", "SCORE", "EXT_SOURCE_3"])
    tagged = fit_stratified_split(loans(spark, sf, ["SK_ID_CURR", "TARGET"])).transform(df, K.SPLIT)
    rating = F.round(1 - F.col("EXT_SOURCE_3"), 6)
    wide = tagged.select(K.SPLIT, K.TARGET, F.col("SCORE").alias("policy"), rating.alias("rating"))
    return wide.unpivot([K.SPLIT, K.TARGET], ["policy", "rating"], "model", "score").where("score IS NOT NULL")


@query("confusion_metrics", """SELECT model, SPLIT, tn, fp, fn, tp, round(precision, 8) AS precision, round(recall, 8) AS recall,
  round(f1, 8) AS f1, round(accuracy, 8) AS accuracy FROM ratios""", {**_TWO, "counts": _COUNTS, "ratios": _RATIOS})
def confusion_metrics(spark, sf):
    return rounded(M.confusion_metrics(two_scores(spark, sf), "score", 0.5, _BY), 8)


@query("roc_curve", "SELECT model, SPLIT, score AS threshold, round(fp / neg, 8) AS fpr, round(tp / pos, 8) AS tpr FROM steps",
       _CURVES)
def roc_curve(spark, sf):
    return rounded(M.roc_curve(two_scores(spark, sf), "score", _BY), 8)


@query("pr_curve", """SELECT model, SPLIT, score AS threshold, round(tp / (tp + fp), 8) AS precision,
  round(tp / pos, 8) AS recall FROM steps""", _CURVES)
def pr_curve(spark, sf):
    return rounded(M.pr_curve(two_scores(spark, sf), "score", _BY), 8)


# ... and a third one without a name, whose scores pass 1: an unnamed group is a group, and no threshold above 1 is chosen
_CURVES = {**_CURVES, "two": _TWO["two"] + " UNION ALL SELECT NULL, SPLIT, TARGET, round(1.6 * SCORE, 6) FROM tagged WHERE SCORE IS NOT NULL"}


def three_scores(spark, sf):
    two = two_scores(spark, sf)
    third = two.where("model = 'policy'").withColumns({"model": F.lit(None).cast("string"), "score": F.round(1.6 * F.col("score"), 6)})
    return two.unionByName(third)


@query("roc_auc", "SELECT model, SPLIT, round(roc_auc, 8) AS roc_auc FROM area", {**_CURVES, "area": _AREA})
def roc_auc(spark, sf):
    return rounded(M.roc_auc(three_scores(spark, sf), "score", _BY).select(*_BY, "roc_auc"), 8)


@query("pr_auc", "SELECT model, SPLIT, round(pr_auc, 8) AS pr_auc FROM area", {**_CURVES, "area": _AREA})
def pr_auc(spark, sf):
    return rounded(M.areas(three_scores(spark, sf), "score", _BY).select(*_BY, "pr_auc"), 8)


_BEST = """SELECT model, SPLIT, score AS threshold, j FROM (SELECT *, tp / pos - fp / neg AS j, row_number() OVER (
  PARTITION BY model, SPLIT ORDER BY tp / pos - fp / neg DESC, score DESC) AS rn FROM steps WHERE score <= 1) WHERE rn = 1"""


@query("youden_threshold", "SELECT model, SPLIT, threshold, round(j, 8) AS j FROM best", {**_CURVES, "best": _BEST})
def youden_threshold(spark, sf):
    return rounded(M.youden_threshold(three_scores(spark, sf), "score", _BY), 8)


@query("choose_threshold", """SELECT model, SPLIT, CASE WHEN j - j0 >= 0.2 THEN threshold ELSE 0.5 END AS threshold,
  round(CASE WHEN j - j0 >= 0.2 THEN j ELSE j0 END, 8) AS j FROM best JOIN (
    SELECT model AS m, SPLIT AS s, recall + tn / (tn + fp) - 1 AS j0 FROM ratios) ON model IS NOT DISTINCT FROM m AND SPLIT = s""",
       {**_CURVES, "best": _BEST, "counts": _COUNTS, "ratios": _RATIOS})
def choose_threshold(spark, sf):
    return rounded(M.choose_threshold(three_scores(spark, sf), "score", _BY).select(*_BY, "threshold", "j"), 8)


_REPORT = {**_CURVES, "area": _AREA, "counts": _COUNTS, "ratios": _RATIOS,
           "report": "SELECT r.*, roc_auc, pr_auc FROM ratios r JOIN area a ON r.model IS NOT DISTINCT FROM a.model AND r.SPLIT = a.SPLIT"}
_NAMES = ["roc_auc", "pr_auc", "precision", "recall", "f1", "accuracy"]


@query("metrics_report", "SELECT model, SPLIT, tn, fp, fn, tp, 0.5::DOUBLE AS threshold, "
       + ", ".join(f"round({m}, 8) AS {m}" for m in _NAMES) + " FROM report", _REPORT)
def metrics_report(spark, sf):
    return rounded(M.model_report(three_scores(spark, sf)), 8)


@query("metrics_flatten", " UNION ALL ".join(
    f"SELECT 'run-1' AS run_id, model, SPLIT || '_{m}' AS \"key\", round({m}, 8) AS value FROM report" for m in _NAMES), {**_REPORT, "two": _TWO["two"]})
def metrics_flatten(spark, sf):
    return rounded(M.flatten_report(M.model_report(two_scores(spark, sf)), "run-1"), 8)


@query("metrics_nested")
def metrics_nested(spark, sf):
    return M.nested_report(M.model_report(two_scores(spark, sf)))


@query("score_exemplars", """SELECT SK_ID_CURR, SCORE, CASE rn WHEN 1 THEN 'low' WHEN n THEN 'high' ELSE 'mid' END AS risk FROM (
  SELECT SK_ID_CURR, SCORE, row_number() OVER (ORDER BY SCORE, SK_ID_CURR) AS rn, count(*) OVER () AS n FROM loans)
  WHERE rn IN (1, n // 2 + 1, n)""")
def score_exemplars(spark, sf):
    return M.score_exemplars(loans(spark, sf, ["SK_ID_CURR", "SCORE"]), "SCORE")


@query("policy_mix", """SELECT SPLIT, recommendation, n, round(n / sum(n) OVER (PARTITION BY SPLIT), 8) AS share,
  round(m, 8) AS mean_score, round(d, 8) AS default_rate FROM (SELECT SPLIT, CASE WHEN SCORE < 0.2 THEN 'Approve'
  WHEN SCORE >= 0.5 THEN 'Reject' ELSE 'Manual Review' END AS recommendation, count(*) AS n, avg(SCORE) AS m,
  avg(TARGET) AS d FROM tagged GROUP BY ALL)""", S.SPLIT_CTES)
def policy_mix(spark, sf):
    df = loans(spark, sf, ["SK_ID_CURR", "TARGET", "SCORE"])
    tagged = fit_stratified_split(df).transform(df, K.SPLIT).withColumn("recommendation", policy_band("SCORE"))
    return rounded(R.policy_mix(tagged, "SCORE", [K.SPLIT]), 8)


# -- drift ------------------------------------------------------------------------------------------------------------

_FEATURES = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "DAYS_BIRTH", "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_3",
             "SPARSE_B", "REGION_RATING_CLIENT"]
_PSI = {
    **S.SPLIT_CTES, "long": S.unpivot("tagged", _FEATURES, ("SPLIT",)),
    "e": f"SELECT feature, {S.edge_list('x', 10)} AS edges FROM long WHERE SPLIT = 'train' AND x IS NOT NULL GROUP BY 1",
    "counts": f"""SELECT feature, SPLIT, {S.edge_bin('x', 'edges', 'left')} AS bin, count(*) AS n FROM long JOIN e
      USING (feature) WHERE x IS NOT NULL GROUP BY ALL""",
    "grid": """SELECT feature, edges, unnest(range(len(edges) - 1)) AS bin, len(edges) - 1 AS k FROM e""",
    "bins": """SELECT g.feature, c.compared, g.bin, edges[g.bin + 1] AS bin_left, edges[g.bin + 2] AS bin_right,
      coalesce(r.n, 0) / sum(coalesce(r.n, 0)) OVER (PARTITION BY g.feature, c.compared) AS ref_share,
      coalesce(s.n, 0) / sum(coalesce(s.n, 0)) OVER (PARTITION BY g.feature, c.compared) AS cmp_share, k
      FROM grid g CROSS JOIN (SELECT unnest(['val', 'test']) AS compared) c
      LEFT JOIN counts r ON r.feature = g.feature AND r.bin = g.bin AND r.SPLIT = 'train'
      LEFT JOIN counts s ON s.feature = g.feature AND s.bin = g.bin AND s.SPLIT = c.compared""",
    "contrib": """SELECT *, (ref_share - cmp_share) * ln(greatest(ref_share, 1e-6) / greatest(cmp_share, 1e-6)) AS part
      FROM bins""",
    "psi": """SELECT feature, sum(part) FILTER (WHERE compared = 'val') AS v, sum(part) FILTER (WHERE compared = 'test') AS t,
      any_value(k)::INT AS k FROM contrib GROUP BY 1"""}
_VERDICT = "CASE WHEN {0} < 0.1 THEN 'no_drift' WHEN {0} < 0.25 THEN 'moderate_drift' ELSE 'major_drift' END"


def _tagged(spark, sf, cols):
    keys = loans(spark, sf, ["SK_ID_CURR", "TARGET"])  # the split needs no joins
    tagged = fit_stratified_split(keys).transform(loans(spark, sf, ["SK_ID_CURR", "TARGET", *cols]), K.SPLIT)
    return materialize(tagged)


@query("psi_bins", """SELECT feature, compared, bin::INT AS bin, round(bin_left, 6) AS bin_left, round(bin_right, 6) AS bin_right,
  round(ref_share, 8) AS ref_share, round(cmp_share, 8) AS cmp_share, round(part, 8) AS psi_contrib FROM contrib""", _PSI)
def psi_bins(spark, sf):
    out, _ = D.psi_bin_table(_tagged(spark, sf, _FEATURES), _FEATURES, decimals=9)
    return rounded(out, 8, bin_left=6, bin_right=6)


@query("psi_table", f"""SELECT feature, round(v, 8) AS psi_train_vs_val, round(t, 8) AS psi_train_vs_test,
  round(greatest(v, t), 8) AS max_psi, {_VERDICT.format('greatest(v, t)')} AS drift_verdict, k AS n_bins_used FROM psi""", _PSI)
def psi_table(spark, sf):
    return rounded(D.compute_psi_table(_tagged(spark, sf, _FEATURES), _FEATURES, decimals=9), 8)


@query("psi_summary", f"""SELECT drift_verdict, count(*) AS n_features, round(max(m), 8) AS worst_psi,
  arg_max(feature, m) AS worst_feature FROM (SELECT feature, greatest(v, t) AS m,
  {_VERDICT.format('greatest(v, t)')} AS drift_verdict FROM psi) GROUP BY 1""", _PSI)
def psi_summary(spark, sf):
    table_ = D.compute_psi_table(_tagged(spark, sf, _FEATURES), _FEATURES, decimals=9)
    return rounded(D.psi_summary(table_), 8)


_WEEK = {
    "ev": "SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '2024-01-01') AS week, event_type AS feature, value AS x FROM events",
    "e": f"""SELECT feature, {S.edge_list('x', 10)} AS edges FROM ev WHERE week = TIMESTAMP '2024-01-01' GROUP BY 1""",
    "counts": f"""SELECT week, feature, bin, count(*) AS n FROM (SELECT week, feature, {S.edge_bin('x', 'edges', 'left')} AS bin
      FROM ev JOIN e USING (feature)) WHERE bin IS NOT NULL GROUP BY ALL""",
    "win": "SELECT DISTINCT week, feature FROM ev WHERE x IS NOT NULL",
    "grid": """SELECT week, feature, unnest(range(len(edges) - 1)) AS bin FROM win JOIN e USING (feature) WHERE len(edges) > 1""",
    "shares": """SELECT g.week, g.feature, g.bin,
      coalesce(r.n, 0) / greatest(sum(coalesce(r.n, 0)) OVER (PARTITION BY g.week, g.feature), 1) AS a,
      coalesce(s.n, 0) / greatest(sum(coalesce(s.n, 0)) OVER (PARTITION BY g.week, g.feature), 1) AS b FROM grid g
      LEFT JOIN counts r ON r.feature = g.feature AND r.bin = g.bin AND r.week = TIMESTAMP '2024-01-01'
      LEFT JOIN counts s ON s.feature = g.feature AND s.bin = g.bin AND s.week = g.week""",
    # features without a reference have NULL, windows with all values outside it their full PSI
    "psi": """SELECT week, feature, sum((a - b) * ln(greatest(a, 1e-6) / greatest(b, 1e-6))) AS psi
      FROM win LEFT JOIN shares USING (week, feature) GROUP BY ALL"""}


def weekly_events(spark, sf, period="true"):
    """Event values by type and week."""
    week = F.window("ts", "7 days", startTime="4 days").start
    return table(spark, sf, "events").where(period).select(
        F.date_format(week, "yyyy-MM-dd").alias("week"), F.col("event_type").alias("feature"), F.col("value").alias("x")
    )


@query("weekly_psi", f"""SELECT strftime(week, '%Y-%m-%d') AS week, feature, round(psi, 8) AS psi,
  CASE WHEN psi IS NOT NULL THEN {_VERDICT.format('psi')} END AS drift_verdict FROM psi""", _WEEK, book=False)
def weekly_psi(spark, sf):
    from ..operators.quantiles import group_quantiles, unique_edges

    long = weekly_events(spark, sf)
    first = weekly_events(spark, sf, "ts >= timestamp'2024-01-01' and ts < timestamp'2024-01-08'")  # reaches the scan
    reference = first.select(F.col("feature").alias("key"), "x")
    edges = {k: unique_edges(q, 9) for k, q in group_quantiles(reference, [i / 10 for i in range(11)]).items()}
    counts = D.bin_counts_long(long, edges, ["week"])
    ref = D.bin_counts_long(first, edges)
    return rounded(D.psi_from_counts(counts, "week", edges, ref), 8)


@query("successive_weeks_psi", f"""SELECT strftime(week, '%Y-%m-%d') AS week, feature, strftime(before, '%Y-%m-%d') AS previous, n,
  round(psi, 8) AS psi, CASE WHEN psi IS NOT NULL THEN {_VERDICT.format('psi')} END AS drift_verdict FROM successive""", {
    **_WEEK, "sizes": "SELECT week, feature, sum(coalesce(n, 0))::BIGINT AS n FROM win LEFT JOIN counts USING (week, feature) GROUP BY ALL",
    "steps": """SELECT *, lag(week) OVER (PARTITION BY feature ORDER BY week) AS before FROM sizes WHERE n > 0
      UNION ALL SELECT *, NULL FROM sizes WHERE false""",
    "successive": """SELECT t.week, t.feature, any_value(t.before) AS before, any_value(t.n) AS n, CASE WHEN any_value(t.before) IS NOT NULL THEN
      sum((q.b - s.b) * ln(greatest(q.b, 1e-6) / greatest(s.b, 1e-6))) END AS psi FROM steps t
      LEFT JOIN shares s ON s.week = t.week AND s.feature = t.feature
      LEFT JOIN shares q ON q.week = t.before AND q.feature = t.feature AND q.bin = s.bin GROUP BY t.week, t.feature"""}, book=False)
def successive_weeks_psi(spark, sf):
    """Every week against the one before it, in the bins of the first week."""
    from ..operators.quantiles import group_quantiles, unique_edges

    first = weekly_events(spark, sf, "ts >= timestamp'2024-01-01' and ts < timestamp'2024-01-08'")
    edges = {k: unique_edges(q, 9) for k, q in group_quantiles(first.select(F.col("feature").alias("key"), "x"), [i / 10 for i in range(11)]).items()}
    counts = D.bin_counts_long(weekly_events(spark, sf), edges, ["week"])
    return rounded(D.psi_between_windows(counts, "week", edges), 8)


_HORIZON = 90


@query("approved_outcomes", f"""SELECT strftime(date_trunc('month', ts), '%Y-%m-%d') AS month, recommendation, count(*) AS n_decided, count(y) AS n_known,
  count(*) FILTER (WHERE y = 1) AS defaults, round(avg(y), 8) AS default_rate FROM (SELECT d.*, o.y FROM decided d LEFT JOIN outcome o
    ON d.id = o.id AND o.at >= d.ts AND o.at <= d.ts + INTERVAL {_HORIZON} DAY) GROUP BY ALL""", {
    "decided": """SELECT o_orderkey AS id, o_orderdate::TIMESTAMP AS ts, CASE WHEN o_orderkey % 10 < 2 THEN 'Approve' WHEN o_orderkey % 10 >= 5 THEN 'Reject'
      ELSE 'Manual Review' END AS recommendation FROM orders""",
    "outcome": """SELECT l_orderkey AS id, max(l_shipdate)::TIMESTAMP AS at, max((l_returnflag = 'R')::INT) AS y FROM lineitem WHERE l_orderkey % 13 <> 0
      GROUP BY l_orderkey"""}, book=False)
def approved_outcomes(spark, sf):
    """Orders as decisions, their last shipment as the outcome: it comes later, sometimes after the horizon or never."""
    from ..streaming.jobs import decision_outcomes

    share = F.col("o_orderkey") % 10 / 10
    decided = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("ts"),
                                                policy_band(share).alias("recommendation"))
    outcome = table(spark, sf, "lineitem").where("l_orderkey % 13 <> 0").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_shipdate").cast("timestamp").alias("at"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("TARGET"))
    joined = decision_outcomes(decided, outcome, "id", horizon=f"{_HORIZON} days")
    out = joined.groupBy(F.date_format(F.trunc("ts", "month"), "yyyy-MM-dd").alias("month"), "recommendation").agg(
        F.count("*").alias("n_decided"), F.count("TARGET").alias("n_known"), F.count_if(F.col("TARGET") == 1).alias("defaults"),
        F.avg("TARGET").alias("default_rate"))
    return rounded(out, 8)


@query("windowed_segment_rate", """SELECT strftime(week, '%Y-%m-%d') AS week, feature AS segment, count(*) AS n,
  round(avg(bad), 8) AS default_rate, round(greatest(avg(bad) - 1.96 * sqrt(avg(bad) * (1 - avg(bad)) / count(*)), 0), 8)
  AS ci_lo, round(least(avg(bad) + 1.96 * sqrt(avg(bad) * (1 - avg(bad)) / count(*)), 1), 8) AS ci_hi
  FROM (SELECT *, (x > 20)::INT AS bad FROM ev) GROUP BY ALL HAVING count(*) >= 100""", {"ev": _WEEK["ev"]}, book=False)
def windowed_segment_rate(spark, sf):
    from ..operators.segments import rate_by

    rows = weekly_events(spark, sf).select("week", F.col("feature").alias("segment"), (F.col("x") > 20).cast("int").alias("bad"))
    return rounded(rate_by(rows, ["week", "segment"], "bad", min_n=100), 8)


# -- ranking on given importances --------------------------------------------------------------------------------------

_ENG = [*K.ENGINEERED, "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY",
        "AMT_GOODS_PRICE", "DAYS_BIRTH", "DAYS_EMPLOYED", "CNT_FAM_MEMBERS"]
_IMP = {
    "fixed": S.FIXED, "eng": S.ENGINEERED.format(source="fixed"),
    "stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(abs(corr("{c}", TARGET)), 9) AS a, round(abs(avg("{c}") FILTER (WHERE TARGET = 1)
          - avg("{c}") FILTER (WHERE TARGET = 0)) / stddev_samp("{c}"), 9) AS b,
          round(count("{c}") / count(*), 9) AS s FROM eng""" for c in _ENG),
    "ranked": """SELECT *, rank() OVER (ORDER BY a DESC)::INT AS ra, rank() OVER (ORDER BY b DESC)::INT AS rb,
      rank() OVER (ORDER BY s DESC)::INT AS rs, count(*) OVER () AS n FROM stats"""}


def importances(spark, sf):
    """Three importance measures read off the data: |r|, standardized mean difference, coverage."""
    eng = engineer_features(fix_sentinel(loans(spark, sf, ["TARGET", *REQUIRED])))
    long = eng.select(K.TARGET, *[F.col(c).cast("double").alias(c) for c in _ENG]).unpivot(K.TARGET, _ENG, "feature", "x")
    y = F.col(K.TARGET)
    gap = F.avg(F.when(y == 1, F.col("x"))) - F.avg(F.when(y == 0, F.col("x")))
    return long.groupBy("feature").agg(
        F.round(F.abs(F.corr("x", y.cast("double"))), 9).alias("xgb_importance"),
        F.round(F.abs(gap) / F.stddev_samp("x"), 9).alias("rf_importance"),
        F.round(F.count("x") / F.count("*"), 9).alias("shap_mean_abs"),
    )


@query("importance_ranks", """SELECT feature, ra AS xgb_rank, rs AS shap_rank FROM ranked""", _IMP)
def importance_ranks(spark, sf):
    from ..operators.stats import importance_rank

    ranked = importance_rank(importance_rank(importances(spark, sf), "xgb_importance", "xgb_rank"), "shap_mean_abs", "shap_rank")
    return ranked.select("feature", "xgb_rank", "shap_rank")


@query("rank_merge", """SELECT feature, a AS xgb_importance, b AS rf_importance, ra AS xgb_rank, rb AS rf_rank,
  (ra + rb) / 2 AS mean_rank, round(((n - ra) / (n - 1) + (n - rb) / (n - 1)) / 2, 8) AS combined_score FROM ranked""", _IMP)
def rank_merge(spark, sf):
    return rounded(L.rank_merge(importances(spark, sf).drop("shap_mean_abs")), 9, combined_score=8)


@query("select_top_n", """SELECT feature, xgb_rank, rf_rank, shap_rank, round(mean_rank, 8) AS mean_rank, round(score, 8)
  AS combined_score, row_number() OVER (ORDER BY mean_rank, feature)::INT AS position FROM (
  SELECT feature, ra AS xgb_rank, rb AS rf_rank, rs AS shap_rank, (ra + rb + rs) / 3 AS mean_rank,
  ((n - ra) / (n - 1) + (n - rb) / (n - 1) + (n - rs) / (n - 1)) / 3 AS score FROM ranked
  ORDER BY mean_rank, feature LIMIT 8)""", _IMP)
def select_top_n(spark, sf):
    imp = importances(spark, sf)
    merged = L.rank_merge(imp.drop("shap_mean_abs"))
    top = L.numbered(L.select_top_n(merged, imp.select("feature", "shap_mean_abs"), 8))
    return rounded(top.select("feature", "xgb_rank", "rf_rank", "shap_rank", "mean_rank", "combined_score", "position"), 8)


_TOP = {**_IMP, "ta": "SELECT feature FROM stats ORDER BY a DESC, feature LIMIT 10",
        "tb": "SELECT feature FROM stats ORDER BY s DESC, feature LIMIT 10"}


@query("topk_agreement", "SELECT feature FROM ta INTERSECT SELECT feature FROM tb", _TOP)
def topk_agreement(spark, sf):
    return L.topk_agreement(importances(spark, sf), "xgb_importance", "shap_mean_abs")


@query("topk_disagreement", """SELECT feature, 'xgb_importance' AS only_in FROM (SELECT * FROM ta EXCEPT SELECT * FROM tb)
  UNION ALL SELECT feature, 'shap_mean_abs' FROM (SELECT * FROM tb EXCEPT SELECT * FROM ta)""", _TOP)
def topk_disagreement(spark, sf):
    return L.topk_disagreement(importances(spark, sf), "xgb_importance", "shap_mean_abs")


@query("importance_bar", """SELECT feature, round(((n - ra) / (n - 1) + (n - rb) / (n - 1)) / 2, 8) AS combined_score,
  CASE WHEN starts_with(feature, 'EXT') THEN 'EXT_SOURCE' ELSE 'Ratio' END AS family FROM ranked
  WHERE starts_with(feature, 'EXT_SOURCE') OR contains(feature, 'RATIO') OR contains(feature, 'INCOME')
  ORDER BY 2 DESC, feature LIMIT 5""", _IMP)
def importance_bar(spark, sf):
    merged = L.rank_merge(importances(spark, sf).drop("shap_mean_abs"))
    return rounded(L.importance_bar(merged, ["EXT_SOURCE", "Ratio"], 5).select("feature", "combined_score", "family"), 8)


# -- applicant inputs --------------------------------------------------------------------------------------------------

_FORM = ["SK_ID_CURR", *R.FORM_SOURCE, *BACKGROUND]
_FORM_SQL = """SELECT SK_ID_CURR, AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, AMT_GOODS_PRICE,
  -DAYS_BIRTH / 365.25::DOUBLE AS AGE_YEARS, -nullif(DAYS_EMPLOYED, 365243) / 365.25::DOUBLE AS EMPLOYED_YEARS,
  EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3, CODE_GENDER, NAME_EDUCATION_TYPE, NAME_CONTRACT_TYPE,
  FLAG_OWN_CAR = 'Y' AS FLAG_OWN_CAR, FLAG_DOCUMENT_3 = 1 AS FLAG_DOCUMENT_3, REGION_POPULATION_RELATIVE, """ \
  + ", ".join(BACKGROUND) + " FROM loans"
_RAW_SQL = {
    "EXT_SOURCE_MEAN": """(coalesce(EXT_SOURCE_1, 0) + coalesce(EXT_SOURCE_2, 0) + coalesce(EXT_SOURCE_3, 0)) / nullif(
      (EXT_SOURCE_1 IS NOT NULL)::INT + (EXT_SOURCE_2 IS NOT NULL)::INT + (EXT_SOURCE_3 IS NOT NULL)::INT, 0)""",
    "CODE_GENDER_M": "(CODE_GENDER = 'M')::INT",
    "NAME_EDUCATION_TYPE_Higher education": "(NAME_EDUCATION_TYPE IN ('Higher education', 'Academic degree'))::INT",
    "NAME_EDUCATION_TYPE_Secondary / secondary special":
        "(NAME_EDUCATION_TYPE IN ('Secondary / secondary special', 'Lower secondary', 'Incomplete higher'))::INT",
    "NAME_CONTRACT_TYPE_Revolving loans": "(NAME_CONTRACT_TYPE = 'Revolving loans')::INT",
    "FLAG_OWN_CAR_Y": "FLAG_OWN_CAR::INT", "FLAG_DOCUMENT_3": "FLAG_DOCUMENT_3::INT",
    "DAYS_BIRTH": "-round(AGE_YEARS * 365.25::DOUBLE)", "DAYS_EMPLOYED": "-round(EMPLOYED_YEARS * 365.25::DOUBLE)",
    "CREDIT_INCOME_RATIO": "CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_CREDIT / AMT_INCOME_TOTAL END",
    "ANNUITY_INCOME_RATIO": "CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_ANNUITY / AMT_INCOME_TOTAL END",
    "CREDIT_GOODS_RATIO": "CASE WHEN AMT_GOODS_PRICE > 0 THEN AMT_CREDIT / AMT_GOODS_PRICE END",
}
_FORM_CTES = {
    "form": _FORM_SQL,
    "raw": "SELECT SK_ID_CURR, " + ", ".join(
        f"({_RAW_SQL.get(c, chr(34) + c + chr(34))})::DOUBLE AS \"{c}\"" for c in K.SCORER_INPUTS) + " FROM form",
    **S.SPLIT_CTES, "fit": "SELECT SK_ID_CURR FROM tagged WHERE SPLIT = 'train'",
    "med": "SELECT " + ", ".join(f"quantile_cont(\"{c}\", 0.5) AS d{i}" for i, c in enumerate(K.SCORER_INPUTS)) + " FROM raw SEMI JOIN fit USING (SK_ID_CURR)",
    "filled": "SELECT SK_ID_CURR, " + ", ".join(
        f"coalesce(\"{c}\", d{i}) AS \"{c}\"" for i, c in enumerate(K.SCORER_INPUTS)) + " FROM raw, med",
    "st": "SELECT " + ", ".join(
        f"avg(\"{c}\") AS m{i}, stddev_pop(\"{c}\") AS s{i}" for i, c in enumerate(K.SCORER_INPUTS)) + " FROM filled SEMI JOIN fit USING (SK_ID_CURR)"}


@query("form_to_features", "SELECT SK_ID_CURR, " + ", ".join(
    f"round((\"{c}\" - m{i}) / s{i}, 6) AS \"{c}\"" for i, c in enumerate(K.SCORER_INPUTS)) + " FROM filled, st", _FORM_CTES)
def form_to_features(spark, sf):
    split_wide_projections(spark)
    book = materialize(loans(spark, sf, [K.TARGET, *_FORM]))
    forms = R.applicant_forms(book)
    raw = materialize(fit_stratified_split(book).transform(R.raw_features(forms, K.ID, K.TARGET), K.SPLIT))  # hashed and derived once
    train = raw.where("SPLIT = 'train'")  # no fitted number sees other rows
    return rounded(R.fit_scorer_inputs(train).transform(raw.drop(K.TARGET, K.SPLIT)))


@query("sensitivity_inputs", """SELECT SK_ID_CURR, field, direction, CASE WHEN abs(v) < 1e-6 THEN NULL
  WHEN field IN ('AGE_YEARS', 'EMPLOYED_YEARS') THEN round_even(v + s * greatest(0.1, 0.1 * abs(v)), 0)
  ELSE round(v + s * greatest(0.1, 0.1 * abs(v)), 6) END AS new_value FROM (""" + " UNION ALL ".join(
    f"SELECT SK_ID_CURR, '{c}' AS field, {c} AS v FROM form" for c in K.WHAT_IF_FIELDS)
    + ") CROSS JOIN (VALUES ('+10%', 1), ('-10%', -1)) d(direction, s) WHERE v IS NOT NULL", {"form": _FORM_SQL})
def sensitivity_inputs(spark, sf):
    forms = R.applicant_forms(loans(spark, sf, _FORM))
    return rounded(R.perturbations(forms, "SK_ID_CURR").select("SK_ID_CURR", "field", "direction", "new_value"))


@query("correlation_with_score", """SELECT feature, n, round(r, 8) AS r FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, corr({c}, SCORE) AS r FROM eng" for c in ["CREDIT_INCOME_RATIO", "AGE_YEARS"])
    + ")", {"eng": S.ENGINEERED.format(source="loans")})
def correlation_with_score(spark, sf):
    eng = engineer_features(loans(spark, sf, ["SCORE", *REQUIRED]))
    return rounded(pearson_target(eng, ["CREDIT_INCOME_RATIO", "AGE_YEARS"], "SCORE").select("feature", "n", "r"), 8)


