"""From applicant forms to model inputs, batch scoring, and what-if tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import map_values, policy_band, row_mean, safe_divide, sentinel_to_null, years_from_days
from .guards import require_columns, require_dataframe
from .scaling import ModelInputSpec, fit_model_input

# raw application columns a form is derived from
FORM_SOURCE = [
    "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_BIRTH", "DAYS_EMPLOYED", "EXT_SOURCE_1",
    "EXT_SOURCE_2", "EXT_SOURCE_3", "CODE_GENDER", "NAME_EDUCATION_TYPE", "NAME_CONTRACT_TYPE", "FLAG_OWN_CAR",
    "FLAG_DOCUMENT_3", "REGION_POPULATION_RELATIVE",
]


def applicant_forms(application: DataFrame) -> DataFrame:
    """Stored applications in form units: years instead of day offsets, booleans instead of flags."""
    require_columns(application, FORM_SOURCE)
    return application.withColumns({
        "AGE_YEARS": years_from_days("DAYS_BIRTH"),
        "EMPLOYED_YEARS": years_from_days(sentinel_to_null("DAYS_EMPLOYED")),
        "FLAG_OWN_CAR": F.col("FLAG_OWN_CAR") == "Y",
        "FLAG_DOCUMENT_3": F.col("FLAG_DOCUMENT_3") == 1,
    }).drop("DAYS_BIRTH", "DAYS_EMPLOYED")


def raw_features(forms: DataFrame, *keys: str) -> DataFrame:
    """The 30 scorer inputs in raw units.  Background columns absent from the form stay NULL until the spec fills them."""
    def indicator(cond):
        return cond.cast("double")

    education = map_values("NAME_EDUCATION_TYPE", K.EDUCATION_INDICATOR)
    derived = {
        "EXT_SOURCE_MEAN": row_mean("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"),
        "CODE_GENDER_M": indicator(F.col("CODE_GENDER") == "M"),
        K.HIGHER_EDUCATION: indicator(education == K.HIGHER_EDUCATION),
        K.SECONDARY_EDUCATION: indicator(education == K.SECONDARY_EDUCATION),
        "NAME_CONTRACT_TYPE_Revolving loans": indicator(F.col("NAME_CONTRACT_TYPE") == "Revolving loans"),
        "FLAG_OWN_CAR_Y": indicator(F.col("FLAG_OWN_CAR")),
        "FLAG_DOCUMENT_3": indicator(F.col("FLAG_DOCUMENT_3")),
        "DAYS_BIRTH": -F.round(F.col("AGE_YEARS") * K.DAYS_PER_YEAR),
        "DAYS_EMPLOYED": -F.round(F.col("EMPLOYED_YEARS") * K.DAYS_PER_YEAR),
        "CREDIT_INCOME_RATIO": safe_divide("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "ANNUITY_INCOME_RATIO": safe_divide("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "CREDIT_GOODS_RATIO": safe_divide("AMT_CREDIT", "AMT_GOODS_PRICE"),
    }
    cols = []
    for c in K.SCORER_INPUTS:
        if c in derived:
            expr = derived[c]
        else:
            expr = F.col(f"`{c}`") if c in forms.columns else F.lit(None)
        cols.append(expr.cast("double").alias(c))
    return forms.select(*keys, *cols)


def fit_scorer_inputs(raw: DataFrame) -> ModelInputSpec:
    """Cohort medians and scaling of the scorer inputs, fitted once in raw units."""
    return fit_model_input(raw, K.SCORER_INPUTS)


def score(
    df: DataFrame, model: Transformer | PipelineModel, required: Sequence[str] = (),
    approve_below: float = K.APPROVE_BELOW, reject_from: float = K.REJECT_FROM, out: str = "probability_of_default",
) -> DataFrame:
    """Append probability and recommendation to every row; also valid on a streaming frame."""
    require_columns(require_dataframe(df), required)
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    scored = scored.drop(*[c for c in ("features", "rawPrediction", "probability", "prediction") if c not in df.columns])
    return scored.withColumn("recommendation", policy_band(out, approve_below, reject_from))


def policy_mix(df: DataFrame, score_col: str, by: Sequence[str] = (), target: str = K.TARGET) -> DataFrame:
    """Rows, share, mean score and default rate per recommendation."""
    per = df.groupBy(*by, "recommendation").agg(
        F.count("*").alias("n"), F.avg(score_col).alias("mean_score"), F.avg(target).alias("default_rate")
    )
    return per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def perturbations(forms: DataFrame, *keys: str) -> DataFrame:
    """(keys, field, direction, base_value, new_value) and the moved form fields: eight fields up and down by 10 %.

    The step is at least 0.1; whole-year fields are rounded half to even; a zero input has no new value.  Each form becomes 16 rows
    inside its task.
    """
    moves = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(d).alias("direction"), F.lit(s).alias("sign"), F.col(f).cast("double").alias("v"))
        for f in K.WHAT_IF_FIELDS for d, s in (("+10%", 1.0), ("-10%", -1.0))
    ]))
    rows = forms.withColumn("_m", moves).where("_m.v IS NOT NULL")
    v = F.col("_m.v")
    moved = v + F.col("_m.sign") * F.greatest(F.lit(0.1), F.abs(v) * 0.1)
    whole = F.col("_m.field").isin(K.WHAT_IF_WHOLE_FIELDS)
    new = F.when(F.abs(v) >= 1e-6, F.when(whole, F.bround(moved)).otherwise(moved))
    rows = rows.withColumns({
        "field": F.col("_m.field"), "direction": F.col("_m.direction"), "base_value": v, "new_value": new,
    })
    return rows.withColumns({
        f: F.when(F.col("field") == f, F.coalesce("new_value", F.col(f).cast("double"))).otherwise(F.col(f).cast("double"))
        for f in K.WHAT_IF_FIELDS
    }).drop("_m")


def sensitivity(
    forms: DataFrame, spec: ModelInputSpec, model: Transformer, *keys: str, **policy
) -> DataFrame:
    """(keys, field, direction, base_value, new_value, probability_of_default, recommendation) from one batch score."""
    tags = [*keys, "field", "direction", "base_value", "new_value"]
    scored = score(spec.transform(raw_features(perturbations(forms, *keys), *tags)), model, **policy)
    return scored.select(*tags, *[moved_only(c) for c in ("probability_of_default", "recommendation")])


def moved_only(result: str) -> Column:
    """A zero input can't be moved: its row stays, without a result."""
    return F.when(F.col("new_value").isNotNull(), F.col(result)).alias(result)
