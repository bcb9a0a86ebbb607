import math

import pytest
from pyspark.sql import functions as F

from lendspark import constants as K
from lendspark.functions import bin_index, clip, feature_family, map_values, policy_band, row_mean, safe_divide, sigmoid
from lendspark.operators.binning import employment_bucket, fit_quantile_edges, histogram, income_band, kde, kde_binned
from lendspark.operators.engineering import engineer_features
from lendspark.operators import quantiles as Q
from lendspark.operators.scaling import fit_scaler
from lendspark.operators.quantiles import exact_quantiles
from lendspark.operators.segments import default_rate_by_segment, segment_column

BASE = {
    "DAYS_BIRTH": -10000.0, "DAYS_EMPLOYED": -2000.0, "AMT_INCOME_TOTAL": 120000.0, "AMT_CREDIT": 240000.0,
    "AMT_ANNUITY": 24000.0, "AMT_GOODS_PRICE": 200000.0, "CNT_FAM_MEMBERS": 4.0, "EXT_SOURCE_1": 0.5, "EXT_SOURCE_2": 0.3,
    "EXT_SOURCE_3": 0.7,
}


def _row(spark, **change):
    row = {**BASE, **change}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))


def test_engineered_values(spark):
    df = _row(spark)
    before = df.columns
    r = engineer_features(df).first()
    assert df.columns == before
    assert r.AGE_YEARS == pytest.approx(27.3785, abs=1e-4)
    assert (r.CREDIT_INCOME_RATIO, r.ANNUITY_INCOME_RATIO, r.CREDIT_GOODS_RATIO) == pytest.approx((2.0, 0.2, 1.2))
    assert r.INCOME_PER_FAM_MEMBER == 30000 and r.EXT_SOURCE_MEAN == pytest.approx(0.5)


def test_engineered_nulls(spark):
    r = engineer_features(_row(spark, AMT_INCOME_TOTAL=0.0, DAYS_EMPLOYED=None, EXT_SOURCE_2=None)).first()
    assert r.CREDIT_INCOME_RATIO is None and r.ANNUITY_INCOME_RATIO is None and r.EMPLOYED_YEARS is None
    assert r.EXT_SOURCE_MEAN == pytest.approx(0.6)
    with pytest.raises(ValueError, match="CNT_FAM_MEMBERS"):
        engineer_features(_row(spark).drop("CNT_FAM_MEMBERS"))


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = df.select(safe_divide("a", "b").alias("d"), clip("a", 2.0, 2.5).alias("c"), row_mean("a", "b").alias("m")).collect()
    assert [r.d for r in got] == [None, None, None, 1.5]
    assert [r.c for r in got] == [2.0, 2.0, None, 2.5]
    assert [r.m for r in got] == [0.5, -0.5, 2.0, 2.5]
    assert spark.range(1).select(sigmoid(F.lit(0.0)).alias("s")).first().s == 0.5


@pytest.mark.parametrize(("p", "band"), [
    (0.0, "Approve"), (0.05, "Approve"), (0.2 - 1e-9, "Approve"), (0.2, "Manual Review"), (0.35, "Manual Review"),
    (0.4999, "Manual Review"), (0.5, "Reject"), (0.99, "Reject"), (None, None),
])
def test_policy(spark, p, band):
    assert spark.range(1).select(policy_band(F.lit(p).cast("double")).alias("b")).first().b == band


@pytest.mark.parametrize(("name", "family"), [
    ("EXT_SOURCE_1", "EXT_SOURCE"), ("DAYS_BIRTH", "Time-derived"), ("AGE_YEARS", "Time-derived"),
    ("FLAG_OWN_CAR_Y", "One-hot / flag"), ("AMT_INCOME_TOTAL", "Ratio"), ("AMT_CREDIT", "Amount"), ("LIVINGAREA_MODE", "Area"),
    ("REGION", "Other"),
])
def test_family(spark, name, family):
    assert spark.range(1).select(feature_family(F.lit(name)).alias("f")).first().f == family


def test_education_map(spark):
    df = spark.createDataFrame([("Academic degree",), ("Lower secondary",), ("unknown",)], "e string")
    got = [r.i for r in df.select(map_values("e", K.EDUCATION_INDICATOR).alias("i")).collect()]
    assert got == [K.HIGHER_EDUCATION, K.SECONDARY_EDUCATION, None]


def test_bins_close_on_the_right_side(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (3.0,), (3.1,), (None,)], "x double")
    edges = [0, 1, 2, 3]
    got = df.select(
        bin_index(F.col("x"), edges).alias("r"), bin_index(F.col("x"), edges, include_end=False).alias("r0"),
        bin_index(F.col("x"), edges, closed="left").alias("l"), bin_index(F.col("x"), edges, "left", False).alias("l0"),
    ).collect()
    assert [r.r for r in got] == [0, 0, 1, 2, None, None]
    assert [r.r0 for r in got] == [None, 0, 1, 2, None, None]
    assert [r.l for r in got] == [0, 1, 1, 2, None, None]
    assert [r.l0 for r in got] == [0, 1, 1, None, None, None]


def test_fixed_bands(spark):
    incomes = spark.createDataFrame([(25000.0,), (80000.0,), (200000.0,), (500000.0,), (5e9,), (None,)], "x double")
    got = [r.b for r in incomes.select(income_band("x").alias("b")).collect()]
    assert got == ["Q1 (<81k)", "Q1 (<81k)", "Q8", "Q10 (270k+)", "Q10 (270k+)", None]
    days = spark.createDataFrame([(-100,), (-365 * 4,), (-20000,), (365243,)], "d long")
    assert [r.b for r in days.select(employment_bucket("d").alias("b")).collect()] == ["<1 yr", "3–5 yrs", "10+ yrs", None]


def test_segments(spark):
    rows = [("a", i % 2) for i in range(100)] + [("b", 0)] * 99 + [("c", 1)] * 150 + [(None, 0)] * 120
    df = spark.createDataFrame(rows, "s string, TARGET int")
    got = default_rate_by_segment(df, "s").collect()
    assert [r.segment for r in got] == ["c", "a", None]
    assert (got[0].default_rate, got[0].ci_lo, got[0].ci_hi) == (1.0, 1.0, 1.0)
    assert got[1].ci_hi == pytest.approx(0.5 + 1.96 * math.sqrt(0.25 / 100))
    assert got[2].default_rate == got[2].ci_lo == 0.0
    assert [r.segment for r in default_rate_by_segment(df, "s", include_null=False).collect()] == ["c", "a"]
    with pytest.raises(ValueError):
        segment_column("Shoe size")


def test_quantile_edges_drop_ties(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 61 + [2] * 20 + [3] * 20], "x double")
    assert fit_quantile_edges(df, "x", 10) == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("bound", [3, 20, 500])
def test_narrowed_quantiles_equal_sorting(spark, bound):
    """The bracket search must agree with a plain sort, also with a value held by a third of the rows."""
    import random

    rng = random.Random(5)
    values = [rng.gauss(0, 1) for _ in range(4000)] + [0.25] * 2000
    other = [float(rng.randint(0, 5)) for _ in range(6000)]
    df = spark.createDataFrame(list(zip(values, other, strict=True)), "x double, y double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.577, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, exact_rows=bound)
    for name, vals in (("x", sorted(values)), ("y", sorted(other))):
        for p, q in zip(probs, got[name], strict=True):
            pos = p * (len(vals) - 1)
            k = int(pos)
            want = vals[k] + (vals[min(k + 1, len(vals) - 1)] - vals[k]) * (pos - k)
            assert q == pytest.approx(want, abs=1e-12), (name, p)


@pytest.mark.parametrize("bound", [2, 50])
def test_wide_columns_need_no_long_form(spark, bound, monkeypatch):
    """Large columns are counted where they lie, and give what ``percentile`` does, with nulls, NaN, both zeros, infinities and hot values."""
    import random

    rng = random.Random(8)
    odd = [None, float("nan"), float("-inf"), -0.0, 0.0, 1e-310, -1e300, float("inf")]
    rows = [(rng.choice(odd) if i % 9 == 0 else rng.expovariate(1) * rng.choice((-1, 1)), float(rng.random() < 0.3), None if i % 2 else i % 40, None) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, y double, z int, void double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    want = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for p in probs])).alias(c) for c in "xyz"]).first()

    def no_long(*_):
        raise AssertionError("long form")

    for name in ("to_long", "_narrowed"):
        monkeypatch.setattr(Q, name, no_long)
    monkeypatch.setattr(Q, "_PARTS", 64)
    got = exact_quantiles(df, ["x", "y", "z", "void"], probs, exact_rows=bound)
    assert set(got) == {"x", "y", "z"}
    for c in got:
        for g, w in zip(got[c], want[c], strict=True):
            assert g == w or (math.isnan(g) and math.isnan(w)), c
    monkeypatch.setattr(Q, "_MANY", 100)
    assert exact_quantiles(df, ["y", "z"], [0.5]) == {"y": [0.0], "z": [19.0]}


def test_scaler_of_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, 5, None), (3.0, 5, None), (None, 5, None)], "a double, b int, void double")
    assert fit_scaler(df, ["void", "b", "a"]).stats == {"b": (5.0, 1.0), "a": (2.0, 1.0)}


def test_histogram_and_density(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)], "x double")
    h = histogram(df, "x", 3).orderBy("bin").collect()
    assert [r.n for r in h] == [3, 3, 4] and h[-1].hi == 9.0
    d = kde(df.withColumn("g", F.lit(1)), "x", "g", points=400, limits=(-20.0, 30.0)).agg(F.sum("density")).first()[0]
    assert d * 50 / 399 == pytest.approx(1.0, abs=1e-3)


@pytest.mark.parametrize("tolerance", [1e-3, 1e-6])
def test_binned_density_keeps_its_bound(spark, tolerance):
    import random

    rng = random.Random(3)
    rows = [("a", rng.gauss(0, 1)) for _ in range(1500)] + [("b", rng.expovariate(1)) for _ in range(700)] + [("b", 0.5)] * 300
    odd = [("a", None), ("a", float("nan")), ("b", float("inf")), (None, 1.0), ("one", 2.0), ("flat", 1.0), ("flat", 1.0)]
    df = spark.createDataFrame(rows + odd, "g string, v double").repartition(5)
    clean = spark.createDataFrame(rows, "g string, v double")
    for limits in (None, (-1.0, 1.5)):
        got = {(r.g, r.point): r for r in kde_binned(df, "v", "g", 50, limits, tolerance).collect()}
        want = kde(clean, "v", "g", 50, limits).collect()
        assert len(got) == 100 and {g for g, _ in got} == {"a", "b"}
        for g in "ab":
            own = [v for k, v in rows if k == g]
            mean = sum(own) / len(own)
            h = math.sqrt(sum((v - mean) ** 2 for v in own) / (len(own) - 1)) * len(own) ** -0.2
            bound = 2 * tolerance / (h * math.sqrt(2 * math.pi)) + 1e-12
            for r in want:
                if r.g == g:
                    assert got[g, r.point].x == pytest.approx(r.x, abs=1e-9) and abs(got[g, r.point].density - r.density) <= bound
    assert kde_binned(df.limit(0), "v", "g").count() == 0
