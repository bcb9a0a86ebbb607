"""Fixed values shared by the operators.

These must equal the published ones for the results to match; they are data, not logic.
"""

# -- fixed values: keys and markers ------------------------------------------------------------------------------------
ID, TARGET, SPLIT = "SK_ID_CURR", "TARGET", "SPLIT"
SPLITS = ("train", "val", "test")
NON_FEATURES = (ID, TARGET, SPLIT)
EMPLOYED_SENTINEL = 365243
MISSING_LABEL = "MISSING"
DAYS_PER_YEAR = 365.25

# -- fixed values: defaults of the cleaning pipeline -------------------------------------------------------------------
DROP_MISSING_ABOVE = 0.60
ONE_HOT_MAX_LEVELS = 10
SPLIT_FRACTIONS = {"train": 0.70, "val": 0.15, "test": 0.15}
SEED = 42

# -- fixed values: decision policy and drift verdicts ------------------------------------------------------------------
APPROVE_BELOW = 0.20
REJECT_FROM = 0.50
PSI_MODERATE_FROM = 0.10
PSI_MAJOR_FROM = 0.25
PSI_BINS = 10
PSI_FLOOR = 1e-6

# -- fixed values: confidence interval multipliers ---------------------------------------------------------------------
Z_ROUNDED = 1.96
Z_EXACT = 1.959963984540054

# -- fixed values: income bands and employment buckets -----------------------------------------------------------------
INCOME_EDGES = [25650, 81000, 99000, 112500, 135000, 147150, 162000, 180000, 225000, 270000, 117000000]
INCOME_LABELS = ["Q1 (<81k)", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7", "Q8", "Q9", "Q10 (270k+)"]
EMPLOYMENT_EDGES = [-1, 1, 3, 5, 10, 100]
EMPLOYMENT_LABELS = ["<1 yr", "1–3 yrs", "3–5 yrs", "5–10 yrs", "10+ yrs"]

# -- fixed values: segment dimensions (name -> source column) ----------------------------------------------------------
SEGMENT_DIMENSIONS = {
    "Income band (deciles)": "AMT_INCOME_TOTAL",
    "Employment length": "DAYS_EMPLOYED",
    "Education": "NAME_EDUCATION_TYPE",
    "Income type": "NAME_INCOME_TYPE",
    "Contract type": "NAME_CONTRACT_TYPE",
    "Gender": "CODE_GENDER",
    "Owns a car": "FLAG_OWN_CAR",
    "Owns realty": "FLAG_OWN_REALTY",
    "Region rating": "REGION_RATING_CLIENT",
}

# -- fixed values: engineered columns ----------------------------------------------------------------------------------
ENGINEERED = [
    "AGE_YEARS",
    "EMPLOYED_YEARS",
    "CREDIT_INCOME_RATIO",
    "ANNUITY_INCOME_RATIO",
    "CREDIT_GOODS_RATIO",
    "INCOME_PER_FAM_MEMBER",
    "EXT_SOURCE_MEAN",
]

# -- fixed values: education -> indicator column -----------------------------------------------------------------------
HIGHER_EDUCATION = "NAME_EDUCATION_TYPE_Higher education"
SECONDARY_EDUCATION = "NAME_EDUCATION_TYPE_Secondary / secondary special"
EDUCATION_INDICATOR = {
    "Higher education": HIGHER_EDUCATION,
    "Secondary / secondary special": SECONDARY_EDUCATION,
    "Lower secondary": SECONDARY_EDUCATION,
    "Incomplete higher": SECONDARY_EDUCATION,
    "Academic degree": HIGHER_EDUCATION,
}

# -- fixed values: scorer inputs, in model order -----------------------------------------------------------------------
SCORER_INPUTS = [
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_1",
    "EMPLOYED_YEARS",
    "EXT_SOURCE_3",
    "CODE_GENDER_M",
    "AMT_CREDIT",
    "AMT_GOODS_PRICE",
    "AMT_ANNUITY",
    "EXT_SOURCE_2",
    "NAME_EDUCATION_TYPE_Higher education",
    "DAYS_BIRTH",
    "AGE_YEARS",
    "CREDIT_GOODS_RATIO",
    "DAYS_ID_PUBLISH",
    "DAYS_EMPLOYED",
    "DAYS_LAST_PHONE_CHANGE",
    "NAME_EDUCATION_TYPE_Secondary / secondary special",
    "NAME_CONTRACT_TYPE_Revolving loans",
    "FLAG_DOCUMENT_3",
    "TOTALAREA_MODE",
    "DAYS_REGISTRATION",
    "YEARS_BEGINEXPLUATATION_MODE",
    "CREDIT_INCOME_RATIO",
    "FLAG_OWN_CAR_Y",
    "LIVINGAREA_MODE",
    "ANNUITY_INCOME_RATIO",
    "AMT_REQ_CREDIT_BUREAU_YEAR",
    "REGION_POPULATION_RELATIVE",
    "DEF_60_CNT_SOCIAL_CIRCLE",
    "LIVINGAREA_MEDI",
]

# -- fixed values: applicant fields the what-if table moves by +-10 % --------------------------------------------------
WHAT_IF_FIELDS = [
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AGE_YEARS",
    "EMPLOYED_YEARS",
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
]
WHAT_IF_WHOLE_FIELDS = ["AGE_YEARS", "EMPLOYED_YEARS"]
