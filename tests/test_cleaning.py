import random

import pytest
from pyspark.sql import functions as F

from lendspark import constants as K
from lendspark.operators import cleaning as C
from lendspark.operators.guards import expect_shape, normalize_missing, require_columns, require_dataframe, require_rows
from lendspark.operators.profiling import dtype_families, missing_top_k
from lendspark.operators.scaling import fit_scaler
from lendspark.operators.splitting import fit_stratified_kfold, fit_stratified_split, only, sample_rows


@pytest.fixture(scope="module")
def toy(spark):
    rng = random.Random(7)
    rows = [(
        i, rng.randint(0, 1), 365243.0 if rng.random() < 0.3 else float(rng.randint(100, 999)),
        None if i % 5 == 0 else rng.gauss(50000, 10000), None if i % 7 == 0 else rng.choice("MF"),
        None if i % 10 < 7 else rng.gauss(0, 1), None if i % 10 < 5 else rng.gauss(0, 1),
    ) for i in range(1, 301)]
    schema = ("SK_ID_CURR long, TARGET int, DAYS_EMPLOYED double, INCOME double, GENDER string, SPARSE_A double, "
              "SPARSE_B double")
    return spark.createDataFrame(rows, schema).persist()


def test_sentinel_replaced_and_counted(toy):
    expected = toy.where(F.col("DAYS_EMPLOYED") == K.EMPLOYED_SENTINEL).count()
    cleaned, spec = C.clean(toy)
    assert spec.sentinel_replaced == expected > 0
    assert cleaned.where(F.col("DAYS_EMPLOYED").isNull() | (F.col("DAYS_EMPLOYED") == K.EMPLOYED_SENTINEL)).count() == 0


def test_sparse_columns_dropped_others_filled(toy):
    cleaned, spec = C.clean(toy)
    assert list(spec.dropped) == ["SPARSE_A"] and abs(spec.dropped["SPARSE_A"] - 0.7) < 1e-12
    assert "SPARSE_A" not in cleaned.columns and "SPARSE_B" in cleaned.columns
    assert all(cleaned.where(F.col(f"`{c}`").isNull()).count() == 0 for c in cleaned.columns)
    assert "GENDER_MISSING" in cleaned.columns and "GENDER_M" in cleaned.columns and "GENDER_F" not in cleaned.columns


def test_thresholds_are_honoured(toy):
    _, spec = C.clean(toy, drop_threshold=0.4, max_levels=2)
    assert set(spec.dropped) == {"SPARSE_A", "SPARSE_B"}
    assert spec.encoding.frequency == ["GENDER"]


def test_scaler_uses_train_rows_only(spark):
    rng = random.Random(0)
    rows = [(i, int(i >= 300), rng.gauss(10 if i < 300 else 20, 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, FEATURE_X double")
    cleaned, spec = C.clean(df)
    means = {r.SPLIT: r.m for r in cleaned.groupBy("SPLIT").agg(F.avg("FEATURE_X").alias("m")).collect()}
    assert set(means) == set(K.SPLITS) and abs(means["train"]) < 1e-9 and abs(means["val"]) < 2
    # changing validation and test rows must not move the fitted statistics
    changed = spec.split.transform(df, "s").withColumn(
        "FEATURE_X", F.when(F.col("s") == "train", F.col("FEATURE_X")).otherwise(F.lit(1e6))).drop("s")
    assert C.fit_cleaning(changed).scaler.stats["FEATURE_X"] == pytest.approx(spec.scaler.stats["FEATURE_X"], rel=1e-12)


def test_fit_on_train_differs_from_all(toy):
    everything = C.fit_cleaning(toy).medians
    train = C.fit_cleaning(toy, fit_on="train").medians
    assert everything.keys() == train.keys() and everything != train


def test_new_rows_use_fitted_values(toy):
    _, spec = C.clean(toy, max_levels=2)
    assert spec.encoding.frequency == ["GENDER"]
    few = toy.where("SK_ID_CURR <= 10")
    part, whole = spec.transform(few), spec.transform(toy).where("SK_ID_CURR <= 10")
    assert sorted(part.collect()) == sorted(whole.select(part.columns).collect())


def test_frequency_tables(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert sorted(r.c for r in C.frequency_encode(df, ["c"]).collect()) == [1.0, 1.0, 2.0, 2.0]
    new = spark.createDataFrame([("a",), ("z",)], "c string")
    assert sorted(r.c for r in C.frequency_encode(new, ["c"], df).collect()) == [0.0, 2.0]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.x for r in fit_scaler(df, ["x"]).transform(df).collect()] == [0.0, 0.0]


def test_split_is_disjoint_complete_and_stable(spark, toy):
    spec = fit_stratified_split(toy)
    tagged = spec.transform(toy, "SPLIT")
    first = {r.SK_ID_CURR: r.SPLIT for r in tagged.collect()}
    again = fit_stratified_split(toy.repartition(13)).transform(toy.repartition(5), "SPLIT")
    assert first == {r.SK_ID_CURR: r.SPLIT for r in again.collect()} and len(first) == 300
    per = {(r.TARGET, r.SPLIT): r["count"] for r in tagged.groupBy("TARGET", "SPLIT").count().collect()}
    for target, sizes in spec.sizes.items():
        assert [per.get((target, s), 0) for s in K.SPLITS] == sizes
    assert only(tagged, "train", "val").count() == sum(s[0] + s[1] for s in spec.sizes.values())


def test_split_honours_fractions(toy):
    spec = fit_stratified_split(toy, fractions={"train": 0.5, "val": 0.25, "test": 0.25}, seed=1)
    assert abs(sum(s[0] for s in spec.sizes.values()) - 150) <= 2
    with pytest.raises(ValueError):
        fit_stratified_split(toy, fractions={"train": 0.9, "val": 0.3})


def test_deep_hash_prefixes_give_the_same_cuts(spark, toy):
    from lendspark.operators.ordering import hash_cuts, hash_prefix_counts

    counts = hash_prefix_counts(toy, "SK_ID_CURR", 3, "TARGET")
    ranks = {0: [10, 50], 1: [7, 70]}
    wide = hash_cuts(toy, "SK_ID_CURR", 3, ranks, "TARGET", counts)
    coarse = counts.groupBy("s").agg(F.sum("n").alias("n")).select("s", F.lit("").alias("p"), "n")
    assert wide == hash_cuts(toy, "SK_ID_CURR", 3, ranks, "TARGET", coarse, single_task_rows=2)


def test_folds_and_samples(toy):
    folds = fit_stratified_kfold(toy, 5).transform(toy, "fold")
    sizes = [r["count"] for r in folds.groupBy("TARGET", "fold").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 300
    assert sample_rows(toy, 40).count() == 40 and sample_rows(toy, 400).count() == 300 and sample_rows(toy, 0).count() == 0


@pytest.mark.parametrize("rows", [200, 200_000])
def test_many_strata_at_any_size(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("SK_ID_CURR"), F.when(F.col("id") % 100 > 0, F.col("id") % 100).cast("int").alias("TARGET"))
    spec = fit_stratified_split(df)
    sizes = {(r.TARGET, r.SPLIT): r["count"] for r in spec.transform(df, "SPLIT").groupBy("TARGET", "SPLIT").count().collect()}
    assert all(sizes[s, "train"] == int(0.7 * rows // 100) for s in [None, *range(1, 100)])


def test_nan_becomes_null(spark):
    df = normalize_missing(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert df.where("x IS NULL").count() == 1


def test_guards(spark, toy):
    with pytest.raises(ValueError, match="NOPE"):
        require_columns(toy, ["TARGET", "NOPE"])
    with pytest.raises(ValueError):
        require_rows(toy.where("1 = 0"))
    with pytest.raises(TypeError):
        require_dataframe([1])
    with pytest.raises(ValueError, match="rows"):
        expect_shape(toy, 10, 7)
    with pytest.raises(ValueError, match="columns"):
        expect_shape(toy, 300, 5)
    assert expect_shape(toy, 300, 7) is toy


def test_profile(toy):
    families = {r.family: r.n_columns for r in dtype_families(toy).collect()}
    assert families == {"int": 2, "float": 4, "object": 1}
    top = missing_top_k(toy, 2).orderBy("rank").collect()
    assert [(r.column, r.rank) for r in top] == [("SPARSE_A", 1), ("SPARSE_B", 2)]
