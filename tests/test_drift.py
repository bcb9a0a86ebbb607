import math
import random

import pytest
from pyspark.sql import functions as F

from lendspark.operators import drift as D


def _sample(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def _normal(seed, n, mean=0.0, scale=1.0):
    rng = random.Random(seed)
    return [rng.gauss(mean, scale) for _ in range(n)]


def _psi(spark, a, b, **kw):
    return D.psi_two_samples(_sample(spark, a), _sample(spark, b), "x", **kw)[0]


def test_identical_samples(spark):
    a = _normal(0, 5000)
    assert _psi(spark, a, a) < 1e-9


def test_same_law_mean_and_scale_shift(spark):
    a = _normal(42, 8000)
    assert _psi(spark, a, _normal(43, 2000)) < 0.10
    assert _psi(spark, a, [v + 1.5 for v in a]) > 0.25
    assert _psi(spark, a, [v * 2 for v in a]) > 0.10


def test_open_ended_bins_keep_outliers(spark):
    a = _normal(1, 3000)
    shifted = [v + 1.5 for v in a]
    assert _psi(spark, a, shifted, open_ended=True) > _psi(spark, a, shifted) * 0.5


def test_missing_values_are_dropped(spark):
    a = [None if i % 10 == 0 else v for i, v in enumerate(_normal(3, 5000))]
    b = [None if i % 13 == 0 else v for i, v in enumerate(_normal(4, 5000))]
    assert 0 <= _psi(spark, a, b) < 0.10


def test_constant_and_empty(spark):
    assert _psi(spark, [1.0] * 50, [1.0] * 50) == 0.0
    with pytest.raises(ValueError):
        _psi(spark, [], [1.0])


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [("train", a, b) for a, b in zip(_normal(0, 7000), _normal(1, 7000), strict=True)]
    rows += [("val", a, b) for a, b in zip(_normal(2, 1500), _normal(3, 1500, 0.8), strict=True)]
    rows += [("test", a, b) for a, b in zip(_normal(4, 1500), _normal(5, 1500, 1.0), strict=True)]
    return spark.createDataFrame(rows, "SPLIT string, stable double, drifting double").persist()


def test_table_ranks_and_classifies(tagged):
    out = D.compute_psi_table(tagged, ["stable", "drifting"]).collect()
    assert [r.feature for r in out] == ["drifting", "stable"]
    assert out[1].drift_verdict == "no_drift" and out[0].max_psi > 0.10 and out[0].n_bins_used == 10
    assert out[0].max_psi == max(out[0].psi_train_vs_val, out[0].psi_train_vs_test)


def test_table_errors(spark, tagged):
    with pytest.raises(ValueError, match="SPLIT"):
        D.compute_psi_table(tagged.drop("SPLIT"), ["stable"])
    with pytest.raises(ValueError, match="nothing"):
        D.compute_psi_table(tagged, ["nothing"])
    with pytest.raises(ValueError):
        D.compute_psi_table(tagged.where("SPLIT <> 'val'"), ["stable"])


def test_constant_feature_has_no_bins(tagged):
    out = D.compute_psi_table(tagged.withColumn("k", F.lit(2.0)), ["k"]).first()
    assert (out.max_psi, out.n_bins_used, out.drift_verdict) == (0.0, 0, "no_drift")


@pytest.mark.parametrize(("psi", "verdict"), [(0.05, "no_drift"), (0.1, "moderate_drift"), (0.15, "moderate_drift"), (0.25, "major_drift"), (0.3, "major_drift")])
def test_verdict(spark, psi, verdict):
    from lendspark.functions import drift_verdict

    assert spark.range(1).select(drift_verdict(F.lit(psi)).alias("v")).first().v == verdict


def test_windows_of_new_features_and_outside_values(spark):
    rows = [("w0", "a", float(i % 10)) for i in range(100)] + [("w1", "a", 99.0)] * 5 + [("w1", "new", 1.0), ("w2", "a", 3.0), ("w2", "a", -7.0)]
    long = spark.createDataFrame([*rows, ("w2", "a", None), ("w3", "gone", None)], "week string, feature string, x double")
    edges = {"a": [0.0, 5.0, 9.0]}
    ref = D.bin_counts_long(long.where("week = 'w0'"), edges)
    counts = D.bin_counts_long(long, edges, ["week"])
    got = {(r.week, r.feature): r for r in D.psi_from_counts(counts, "week", edges, ref).collect()}
    assert set(got) == {("w0", "a"), ("w1", "a"), ("w1", "new"), ("w2", "a")}
    assert got["w0", "a"].psi == 0 and got["w2", "a"].drift_verdict == "major_drift"
    assert got["w1", "new"].psi is None and got["w1", "new"].drift_verdict is None
    assert got["w1", "a"].psi == pytest.approx(2 * 0.5 * math.log(0.5 / 1e-6)) and got["w1", "a"].drift_verdict == "major_drift"
    wide = spark.createDataFrame([("w1", 99.0)], "week string, a double")
    assert D.psi_by_window(wide, ["a"], "week", edges, ref).first().drift_verdict == "major_drift"
