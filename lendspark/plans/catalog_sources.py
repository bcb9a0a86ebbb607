"""Queries: readers, writers and file audits on the loan book, written to a folder of the run and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import metrics as M
from ..operators.splitting import fit_stratified_split
from ..session import run_folder
from ..sources import audits, files
from . import sqlparts as S
from .catalog_metrics import _NAMES, _REPORT, _TWO, two_scores
from .loans import loans
from .registry import query

_COLUMNS = ["SK_ID_CURR", "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "NAME_EDUCATION_TYPE", "CODE_GENDER"]
_SELECT = f"SELECT {', '.join(_COLUMNS)} FROM loans"


@query("csv_round_trip", _SELECT)
def csv_round_trip(spark, sf):
    """Typed CSV out and in; the number of rows and columns is checked on the way."""
    df = loans(spark, sf, _COLUMNS)
    path = run_folder(spark)
    files.write_csv(df, path)
    return files.read_applications(spark, path, df.schema, rows=df.count(), cols=len(_COLUMNS))


@query("csv_inferred_types", """SELECT 'int' AS family, count(*) AS n FROM loans WHERE SK_ID_CURR IS NOT NULL
  UNION ALL SELECT 'double', count(*) FROM loans WHERE AMT_CREDIT IS NOT NULL""")
def csv_inferred_types(spark, sf):
    """Types are inferred once from the file; values of the inferred families are counted."""
    path = run_folder(spark)
    files.write_csv(loans(spark, sf, ["SK_ID_CURR", "AMT_CREDIT"]).withColumn("AMT_CREDIT", F.col("AMT_CREDIT") + F.lit(0.25)), path)
    df = files.read_applications(spark, path, files.infer_csv_schema(spark, path))
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(kinds[c]) for c in df.columns])
    return counts.unpivot([], counts.columns, "family", "n")


@query("slice_round_trip", "SELECT SK_ID_CURR, TARGET FROM tagged WHERE SPLIT = 'val'", S.SPLIT_CTES)
def slice_round_trip(spark, sf):
    """A table partitioned by split; one slice and two columns are read back."""
    df = loans(spark, sf, _COLUMNS)
    path = run_folder(spark)
    files.write_table(fit_stratified_split(df).transform(df, K.SPLIT), path, K.SPLIT)
    chosen = files.first_existing(spark, [f"{path}-preferred", path])
    return files.read_table(spark, chosen, ["SK_ID_CURR", "TARGET", K.SPLIT]).where("SPLIT = 'val'").drop(K.SPLIT)


_LINE = "concat_ws(',', SK_ID_CURR, TARGET, CASE WHEN SK_ID_CURR % 7 > 0 THEN CODE_GENDER END)"


@query("ragged_records", f"SELECT {_LINE} AS record FROM loans WHERE SK_ID_CURR % 7 = 0 OR CODE_GENDER IS NULL")
def ragged_records(spark, sf):
    """Records with another number of fields than the header."""
    path = run_folder(spark)
    loans(spark, sf, ["SK_ID_CURR", "TARGET", "CODE_GENDER"]).select(F.expr(_LINE).alias("value")).write.text(path)
    return audits.ragged_records(spark, path, ["SK_ID_CURR", "TARGET", "CODE_GENDER"])


@query("line_audit", """SELECT sum(1 + (SK_ID_CURR % 5 = 0)::INT)::BIGINT AS physical_lines, count(*) AS parsed_rows FROM loans""")
def line_audit(spark, sf):
    """Lines against records, where every fifth record holds a line break.  Headers are lines of their own and taken off."""
    path = run_folder(spark)
    note = F.when(F.col("SK_ID_CURR") % 5 == 0, F.lit("two\nlines")).otherwise(F.lit("one"))
    files.write_csv(loans(spark, sf, ["SK_ID_CURR"]).withColumn("note", note), path)
    headers = spark.read.text(path).where("value = 'SK_ID_CURR,note'").count()
    return audits.line_audit(spark, path).withColumn("physical_lines", F.col("physical_lines") - headers)


@query("run_log", "SELECT model, SPLIT || '_' || k AS \"key\", v AS value, NULL::VARCHAR AS text FROM (" + " UNION ALL ".join(
    f"SELECT model, SPLIT, '{m}' AS k, round({m}, 8) AS v FROM report" for m in _NAMES)
    + ") UNION ALL SELECT NULL, 'owner', NULL, 'risk'", {**_REPORT, "two": _TWO["two"]})
def run_log(spark, sf):
    """Metrics and tags of a run, appended to the log and read back."""
    path = run_folder(spark)
    files.append_run_log(M.model_report(two_scores(spark, sf)), "run-1", path, {"owner": "risk"})
    return files.read_table(spark, path).where("run_id = 'run-1'").select("model", "key", F.round("value", 8).alias("value"), "text")
