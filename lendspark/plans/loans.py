"""A loan book over order tables.

One definition per column, as an expression both Spark and a SQL engine read, so the same book can be derived on either
side of a check.  Joins a caller does not need are left out; all of them are left joins to primary keys, so leaving one
out never changes the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ID = "o_orderkey"
_F = "o_orderstatus = 'F'"

LINES = {
    "goods": "round(sum(l_extendedprice), 2)",
    "annuity": "round(sum(l_extendedprice * l_discount), 4)",
    "d10": "round(avg(l_discount) * 10, 6)",
    "t10": "round(avg(l_tax) * 10, 6)",
    "q50": "round(avg(l_quantity) / 50, 6)",
}

# column -> (tables beyond orders, expression)
COLUMNS: dict[str, tuple[str, str]] = {
    "SK_ID_CURR": ("", _ID),
    "TARGET": ("", f"CASE WHEN {_F} THEN 1 ELSE 0 END"),
    "AMT_CREDIT": ("", "o_totalprice"),
    "AMT_INCOME_TOTAL": ("customer", "round(c_acctbal * 12, 2)"),
    "AMT_GOODS_PRICE": ("lines", "goods"),
    "AMT_ANNUITY": ("lines", "annuity"),
    "CNT_FAM_MEMBERS": ("customer", "CAST(c_nationkey AS DOUBLE)"),
    "DAYS_BIRTH": ("", "-datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE))"),
    "DAYS_EMPLOYED": ("", f"CASE WHEN {_ID} % 7 = 0 THEN 365243 ELSE -(({_ID} * 37) % 9000) END"),
    "EXT_SOURCE_1": ("lines", f"CASE WHEN {_ID} % 2 = 0 THEN NULL ELSE d10 END"),
    "EXT_SOURCE_2": ("lines", f"CASE WHEN {_ID} % 5 = 0 THEN NULL ELSE t10 END"),
    "EXT_SOURCE_3": ("lines", f"CASE WHEN {_ID} % 11 = 0 THEN NULL ELSE q50 END"),
    "SPARSE_A": ("", f"CASE WHEN {_ID} % 10 < 7 THEN NULL ELSE CAST({_ID} % 100 AS DOUBLE) END"),
    "SPARSE_B": ("", f"CASE WHEN {_ID} % 10 < 5 THEN NULL ELSE CAST({_ID} % 100 AS DOUBLE) END"),
    "NAME_INCOME_TYPE": ("customer", "c_mktsegment"),
    "NAME_EDUCATION_TYPE": ("", f"""CASE WHEN {_ID} % 9 = 0 THEN NULL
        WHEN o_orderpriority = '1-URGENT' THEN 'Higher education' WHEN o_orderpriority = '2-HIGH' THEN 'Academic degree'
        WHEN o_orderpriority = '3-MEDIUM' THEN 'Secondary / secondary special'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Incomplete higher' ELSE 'Lower secondary' END"""),
    "OCCUPATION_TYPE": ("nation", "n_name"),
    "NAME_CONTRACT_TYPE": ("", f"CASE WHEN {_ID} % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END"),
    "CODE_GENDER": ("", f"CASE WHEN {_ID} % 3 = 0 THEN 'M' ELSE 'F' END"),
    "FLAG_OWN_CAR": ("", f"CASE WHEN {_ID} % 4 = 0 THEN 'Y' ELSE 'N' END"),
    "FLAG_OWN_REALTY": ("", f"CASE WHEN {_ID} % 5 < 3 THEN 'Y' ELSE 'N' END"),
    "REGION_RATING_CLIENT": ("nation", "n_regionkey + 1"),
    "REGION_POPULATION_RELATIVE": ("", f"CAST({_ID} * 13 % 100 AS DOUBLE) / 1000"),
    "FLAG_DOCUMENT_3": ("", f"CASE WHEN {_ID} % 10 < 7 THEN 1 ELSE 0 END"),
    "DAYS_ID_PUBLISH": ("", f"-(({_ID} * 13) % 6000)"),
    "DAYS_REGISTRATION": ("", f"-(({_ID} * 17) % 15000)"),
    "DAYS_LAST_PHONE_CHANGE": ("", f"-(({_ID} * 7) % 3000)"),
    "TOTALAREA_MODE": ("", f"CASE WHEN {_ID} % 2 = 1 THEN NULL ELSE CAST({_ID} * 31 % 1000 AS DOUBLE) / 1000 END"),
    "LIVINGAREA_MODE": ("", f"CASE WHEN {_ID} % 2 = 0 THEN NULL ELSE CAST({_ID} * 29 % 1000 AS DOUBLE) / 1000 END"),
    "LIVINGAREA_MEDI": ("", f"CASE WHEN {_ID} % 2 = 0 THEN NULL ELSE CAST({_ID} * 23 % 1000 AS DOUBLE) / 1000 END"),
    "YEARS_BEGINEXPLUATATION_MODE": ("", f"CASE WHEN {_ID} % 4 = 1 THEN NULL ELSE CAST({_ID} * 19 % 1000 AS DOUBLE) / 1000 END"),
    "AMT_REQ_CREDIT_BUREAU_YEAR": ("", f"CASE WHEN {_ID} % 8 = 0 THEN NULL ELSE CAST({_ID} % 7 AS DOUBLE) END"),
    "DEF_60_CNT_SOCIAL_CIRCLE": ("", f"CAST({_ID} % 5 AS DOUBLE)"),
    "SCORE": ("", f"""round(CAST(({_ID} * 7919) % 1000 AS DOUBLE) / 1000 * CAST(0.6 AS DOUBLE)
        + CASE WHEN {_F} THEN CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 6)"""),
}

# the applicant table used by the cleaning pipeline
APPLICATION = [
    "SK_ID_CURR", "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "AMT_ANNUITY", "CNT_FAM_MEMBERS",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "SPARSE_A", "SPARSE_B",
    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "REGION_RATING_CLIENT",
]
NUMERIC = [
    "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "SPARSE_A", "SPARSE_B", "REGION_RATING_CLIENT",
]
BACKGROUND = [
    "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE", "TOTALAREA_MODE", "DAYS_REGISTRATION", "YEARS_BEGINEXPLUATATION_MODE",
    "LIVINGAREA_MODE", "AMT_REQ_CREDIT_BUREAU_YEAR", "DEF_60_CNT_SOCIAL_CIRCLE", "LIVINGAREA_MEDI",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(APPLICATION)) -> DataFrame:
    """The loan book with the named columns."""
    needs = {COLUMNS[c][0] for c in columns}
    book = table(spark, sf_dir, "orders")
    if needs & {"customer", "nation"}:
        customer = table(spark, sf_dir, "customer")
        book = book.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "nation" in needs:
        book = book.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if "lines" in needs:
        used = [n for n in LINES if any(n in COLUMNS[c][1] for c in columns)]
        lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.expr(LINES[n]).alias(n) for n in used])
        book = book.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return book.select(*[F.expr(COLUMNS[c][1]).alias(c) for c in columns])


def loans_cte() -> str:
    """The same book as two common table expressions ``lines`` and ``loans``."""
    exprs = {c: e for c, (_, e) in COLUMNS.items()}
    exprs["DAYS_BIRTH"] = "-date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')"
    body = ", ".join(f"{e} AS {c}" for c, e in exprs.items())
    aggs = ", ".join(f"{e} AS {n}" for n, e in LINES.items())
    return (
        f"lines AS (SELECT l_orderkey, {aggs} FROM lineitem GROUP BY l_orderkey), "
        f"loans AS (SELECT {body} FROM orders LEFT JOIN customer ON o_custkey = c_custkey "
        "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN lines ON o_orderkey = l_orderkey)"
    )
