"""Boosted trees, the network and the joint logistic fits against brute force."""

import itertools
import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lendspark import constants as K
from lendspark.operators import attribution as A
from lendspark.operators import boosting as B
from lendspark.operators import network as N
from lendspark.operators import newton as W
from lendspark.operators import quantiles as Q
from lendspark.operators.metrics import areas
from lendspark.operators.splitting import fit_stratified_split, only
from lendspark.plans import catalog_models as P

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        a, b = rng.gauss(0, 1), rng.choice([1.0, 2.0, 5.0, None])
        c = float("nan") if i % 11 == 0 else rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * a - (1.5 if b is None else 0) - 1))))
        rows.append((i, None if i % 50 == 7 else y, None if i % 9 == 0 else a, b, c))
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, b double, c double")
    return fit_stratified_split(df).transform(df, K.SPLIT).persist()


def rows_of(df, names=NAMES):
    rows = df.where("TARGET is not null").select("TARGET", *names).collect()
    return np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], dtype=float), np.array([r[0] for r in rows], dtype=float)


def brute_tree(x, g, h, rows, depth, cuts, rate, lam=1.0):
    """The best tree by trying every feature, cut and side for the missing; nested (feature, cut, null_left, left, right) or a leaf value."""
    G, H = g[rows].sum(), h[rows].sum()
    best = (1e-6, None)
    if depth:
        for f in range(x.shape[1]):
            for cut in cuts[f]:
                for null_left in (False, True):
                    void = np.isnan(x[rows, f])
                    left = np.where(void, null_left, x[rows, f] <= cut)
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    if hl < 1 or H - hl < 1:
                        continue
                    gain = gl * gl / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G * G / (H + lam)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, null_left, left))
    if best[1] is None:
        return -rate * G / (H + lam)
    f, cut, null_left, left = best[1]
    return (f, cut, null_left, brute_tree(x, g, h, rows[left], depth - 1, cuts, rate), brute_tree(x, g, h, rows[~left], depth - 1, cuts, rate))


def brute_value(tree, row):
    while isinstance(tree, tuple):
        f, cut, null_left, left, right = tree
        tree = left if (null_left if np.isnan(row[f]) else row[f] <= cut) else right
    return tree


@pytest.mark.parametrize("imbalance,local", [("pos_weight", 0), ("none", 10 ** 7)])
def test_trees_equal_a_brute_force_search(spark, frame, imbalance, local, monkeypatch):
    monkeypatch.setattr(B, "LOCAL_BYTES", local)
    monkeypatch.setattr(B, "REFRESH", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    train = only(frame, "train")
    model = B.train_boosted(train.repartition(4), NAMES, n_trees=5, max_depth=3, learning_rate=0.3, imbalance=imbalance)
    x, y = rows_of(train)
    w = np.where(y == 1, (len(y) - y.sum()) / y.sum() if imbalance == "pos_weight" else 1.0, 1.0)
    cuts = B.fit_cuts(train, NAMES)
    margin, trees = np.zeros(len(y)), []
    for _ in range(5):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * w * 2 ** 20) / 2 ** 20, np.rint(p * (1 - p) * w * 2 ** 20) / 2 ** 20
        trees.append(brute_tree(x, g, h, np.arange(len(y)), 3, [cuts[f] for f in NAMES], 0.3))
        margin = margin + np.array([brute_value(trees[-1], r) for r in x])
    assert np.abs(model.margins(x) - margin).max() < 1e-9
    test = only(frame, "test")
    scored = {r.SK_ID_CURR: r.score for r in model.score(test.repartition(3)).collect()}
    for r in test.collect():
        row = [np.nan if r[f] is None else r[f] for f in NAMES]
        assert scored[r.SK_ID_CURR] == pytest.approx(1 / (1 + math.exp(-sum(brute_value(t, row) for t in trees))), abs=1e-9)
    assert areas(model.score(test), "score").first().roc_auc > 0.75
    monkeypatch.setattr(B, "LOCAL_BYTES", 10 ** 7 - local)
    again, other = B.train_boosted_grid(train.repartition(7), NAMES, [{"max_depth": 3, "learning_rate": 0.3, "imbalance": imbalance}, {"max_depth": 1}], n_trees=5)
    assert (again.trees == model.trees).all()  # whatever the partitions, and whoever adds up
    assert other.trees.shape == (5, 3) and (other.trees["feature"][:, 0] >= 0).all()


def test_rows_walk_each_tree_once_and_nothing_stays(spark, frame, monkeypatch):
    train = only(frame, "train")
    near = B.train_boosted(train, NAMES, n_trees=6, max_depth=2)
    for name, value in (("LOCAL_BYTES", 0), ("REFRESH", 2), ("BLOCK_ROWS", 60), ("JOINED", 2), ("FAN_IN", 3)):
        monkeypatch.setattr(B, name, value)
    moves, kept = [], spark._jsc.getPersistentRDDs().size()
    advanced = B._advanced
    monkeypatch.setattr(B, "_advanced", lambda blocks, width, trees: moves.append(1) or advanced(blocks, width, trees))
    far = B.train_boosted(train.repartition(5), NAMES, n_trees=6, max_depth=2)
    assert (near.trees == far.trees).all()
    assert len(moves) == 5  # margins go on with every tree, so no job walks older ones
    assert spark._jsc.getPersistentRDDs().size() == kept


def test_some_megabytes_take_no_job_a_level(spark, monkeypatch):
    """9 MB of packed rows: each setting's trees grow in one task, not in a job a level, and are those that jobs grow."""
    rows = spark.range(750_000).select((F.col("id") % 7 < 2).cast("int").alias("TARGET"), *[F.pmod(F.xxhash64("id", F.lit(f)), F.lit(90)).alias(f) for f in "abc"])
    rows = rows.withColumn("a", F.when(F.col("a") < 80, F.col("a") + 9 * F.col("TARGET")))
    grid = [{"max_depth": 2}, {"max_depth": 3, "learning_rate": 0.3, "imbalance": "none"}]

    def no_job(*_):
        raise AssertionError("a job a level")

    with monkeypatch.context() as only_tasks:
        only_tasks.setattr(B, "histograms", no_job)
        near = B.train_boosted_grid(rows, ["a", "b", "c"], grid, n_trees=3)
    monkeypatch.setattr(B, "LOCAL_BYTES", 0)
    far = B.train_boosted_grid(rows, ["a", "b", "c"], grid, n_trees=3)
    assert all((m.trees == n.trees).all() and (m.trees["feature"][:, 0] >= 0).all() for m, n in zip(near, far))


def test_boosted_trees_are_stored_and_explained(spark, frame, tmp_path):
    train, test = only(frame, "train"), only(frame, "test")
    model = B.train_boosted(train, NAMES, n_trees=4, max_depth=3, learning_rate=0.3)
    model.save(spark, str(tmp_path / "m"))
    loaded = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert (loaded.trees == model.trees).all() and loaded.features == NAMES and loaded.config == model.config
    assert sum(model.importances().values()) == pytest.approx(1) and max(model.importances(), key=model.importances().get) == "a"
    leaves = model.leaves()
    x, _ = rows_of(test)
    got = A.leaf_attributions(x[:25], leaves)

    def value(row, known):
        total = 0.0
        for v, conds in leaves:
            for f, lo, hi, share, void in conds:
                v *= (void if np.isnan(row[f]) else lo < row[f] <= hi) if f in known else share
            total += v
        return total

    for row, phi in zip(x[:25], got):
        expected = [0.0] * 3
        for order in itertools.permutations(range(3)):
            for i, f in enumerate(order):
                expected[f] += (value(row, set(order[:i + 1])) - value(row, set(order[:i]))) / 6
        assert phi == pytest.approx(expected, abs=1e-9)
        assert phi.sum() + value(row, set()) == pytest.approx(model.margins(row[None])[0], abs=1e-9)
    assert A.leaf_attributions(x, leaves, [(c, None, v) for v, c in leaves if c]) == pytest.approx(A.leaf_attributions(x, leaves), abs=1e-12)
    shap = {r.feature: r.shap_mean_abs for r in A.mean_abs_attribution(model, test, K.ID).collect()}
    whole, _ = rows_of(test.withColumn("TARGET", F.lit(1)))
    assert [shap[f] for f in NAMES] == pytest.approx(np.abs(A.leaf_attributions(whole, leaves)).mean(axis=0), abs=1e-9)


@pytest.mark.parametrize("depth,width", [(1, 3), (4, 6), (6, 5), (8, 9), (9, 4)])
def test_shared_tables_equal_leaves(spark, depth, width, monkeypatch):
    """Trees of any shape, with features that come again on a path; deep ones go by leaf."""
    monkeypatch.setattr(A, "HELD_ROWS", 40)
    monkeypatch.setattr(A, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(depth)
    trees = np.zeros((3, (1 << depth + 1) - 1), dtype=B._NODE)
    trees["feature"], trees["cover"][:, 0] = -1, 100.0
    for tree in trees:
        for k in range((1 << depth) - 1):
            if tree["cover"][k] and (k < 3 or rng.random() < 0.8):
                tree["feature"][k], tree["cut"][k], tree["null_left"][k] = rng.integers(width), np.round(rng.normal(), 1), rng.random() < 0.5
                share = rng.random()
                tree["cover"][2 * k + 1], tree["cover"][2 * k + 2] = tree["cover"][k] * share, tree["cover"][k] * (1 - share)
                tree["value"][2 * k + 1:2 * k + 3] = rng.normal(size=2)
    names = [f"f{i}" for i in range(width)]
    model = B.BoostedTrees("gbt", names, trees)
    x = np.round(rng.normal(size=(90, width)), 1)
    x[rng.random(x.shape) < 0.15] = np.nan
    expected = A.leaf_attributions(x, model.leaves())
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(x.tolist())], ["id", *names]).repartition(2)
    got = {(r.id, r.feature): r.attribution for r in A.attributions(model, df, "id").collect()}
    assert [got[i, f] for i in range(90) for f in names] == pytest.approx(expected.ravel().tolist(), abs=1e-12)
    mean = {r.feature: r.shap_mean_abs for r in A.mean_abs_attribution(model, df, "id").collect()}
    assert [mean[f] for f in names] == pytest.approx(np.abs(expected).mean(axis=0).tolist(), abs=1e-12)


def test_attribution_query_explains_all_train_rows(spark, monkeypatch):
    """6,000 train rows: the mean is over all of them, not over a sample."""
    rows = spark.range(6200).select(F.col("id").alias(K.ID), F.when(F.col("id") < 6000, "train").otherwise("val").alias(K.SPLIT),
                                    *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000).alias(c) for k, c in enumerate(NAMES)])
    tree = np.zeros((1, 3), dtype=B._NODE)
    tree["feature"], tree["cut"][0, 0], tree["cover"], tree["value"] = [0, -1, -1], 0.3, [[10.0, 3.0, 7.0]], [[0.0, 2.0, -1.0]]
    monkeypatch.setattr(P, "input_frame", lambda spark, sf: rows)
    monkeypatch.setattr(P, "selection_trees", lambda spark, sf: B.BoostedTrees("gbt", NAMES, tree))
    monkeypatch.setattr(P, "_KEPT", {})
    low = rows.where("SPLIT = 'train' and a <= 0.3").count() / 6000
    got = {r.feature: r.shap_mean_abs for r in P.attribution_table(spark, "nowhere").collect()}
    assert got["a"] == pytest.approx(low * (2 + 0.1) + (1 - low) * (1 - 0.1), abs=1e-12) and got["b"] == got["c"] == 0


def test_boosting_of_nothing(spark, frame):
    for df in (frame.where("false"), frame.where("TARGET = 1"), frame.withColumn("TARGET", F.lit(None).cast("int"))):
        model = B.train_boosted(df, NAMES, n_trees=2, max_depth=2)
        assert (model.trees["feature"] < 0).all() and model.score(frame).where("score is null").count() == 0


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(0)
    sizes = [5, 7, 4, 1]
    params = N.start(sizes, 1)
    x, y, w = rng.normal(size=(9, 5)), (rng.random(9) < 0.5) * 1.0, rng.random(9) + 0.5
    for dropped in (N.masks(sizes, 9, 0.3, [1, 2]), []):
        _, g = N.loss_and_gradient(params, x, y, w, dropped)
        flat = N._flat(params)
        for i in range(len(flat)):
            e = np.zeros_like(flat)
            e[i] = 1e-6
            up, down = (N.loss_and_gradient(N._shaped(flat + s * e, params), x, y, w, dropped)[0] for s in (1, -1))
            assert (up - down) / 2e-6 == pytest.approx(N._flat(g)[i], abs=1e-6)


def test_network_learns_stops_and_is_stored(spark, frame, tmp_path, monkeypatch):
    train, val, test = (only(frame, s) for s in K.SPLITS)
    model = N.train_network(train, val, NAMES, hidden=(8, 4), epochs=6, rate=0.02, batch_size=64, id_col=K.ID)
    assert areas(model.score(test), "score").first().roc_auc > 0.75
    assert model.config["best_val_auc"] == max(h["val_auc"] for h in model.config["history"])
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)  # several blocks a mini-batch give the same sums
    whole, cut = (N.mini_batches(train.where("TARGET is not null").fillna(0.0), NAMES, K.ID, K.TARGET, F.lit(1.0), 3, size, 1) for size in (16, 100))
    params = N.start([3, 4, 1], 2)
    for step in range(3):
        a, b = (N.gradient(t, step, params, [3, 4, 1], 0.0, [0], 4) for t in (whole, cut))
        assert a[2] == b[2] and N._flat(a[0]) == pytest.approx(N._flat(b[0]))
    model.save(spark, str(tmp_path / "n"))
    first, again = ({r.SK_ID_CURR: r.score for r in m.score(test).collect()} for m in (model, N.NetworkModel.load(spark, str(tmp_path / "n"))))
    assert first == again
    monkeypatch.setattr(N, "LOCAL_BYTES", 0)
    waited = N.train_network(train, val, NAMES, hidden=(4,), epochs=9, rate=0.0, batch_size=200, patience=2, id_col=K.ID)
    assert waited.config["epochs"] == 3  # no epoch is better than the first


def test_chained_steps_equal_the_local_ones(spark, frame, monkeypatch):
    train, val = only(frame, "train"), only(frame, "val")
    args = dict(hidden=(6, 3), epochs=2, batch_size=40, id_col=K.ID, imbalance="none")
    near = N.train_network(train, val, NAMES, **args)
    monkeypatch.setattr(N, "LOCAL_BYTES", 0)
    monkeypatch.setattr(N, "CHAIN", 7)
    jobs, chained = [], N.chained
    monkeypatch.setattr(N, "chained", lambda *a: jobs.append(len(a[2])) or chained(*a))
    far = N.train_network(train.repartition(3), val, NAMES, **args)
    assert N._flat(far.params) == pytest.approx(N._flat(near.params), abs=1e-12)
    assert [h["loss"] for h in far.config["history"]] == pytest.approx([h["loss"] for h in near.config["history"]])
    assert max(jobs) == 7 and sum(jobs) >= 2 * 13  # seven steps a job


def test_features_move_in_one_pass(spark, frame, monkeypatch):
    """Each feature's AUC drop, from rows moved once: the scores of plainly swapped rows."""
    monkeypatch.setattr(A, "MOVED_ROWS", 50)
    train, val = only(frame, "train"), only(frame, "val").where("TARGET is not null")
    model = B.train_boosted(train, NAMES, n_trees=6, max_depth=3, learning_rate=0.3)
    x, _ = rows_of(val)
    moved = np.roll(x, 1, axis=0)
    plain = [model.margins(x)]
    for f in range(3):
        swapped = x.copy()
        swapped[:, f] = moved[:, f]
        plain.append(model.margins(swapped))
    assert [m.tolist() for m in model.margins_moved(x, moved)] == [m.tolist() for m in plain]
    scored = []
    monkeypatch.setattr(B.BoostedTrees, "score", lambda *a: scored.append(1))  # no scan of its own for each feature
    drops = {r.feature: r.auc_drop for r in A.permutation_importance(model, val, K.ID, K.TARGET).collect()}
    assert not scored and set(drops) == set(NAMES) and drops["a"] > 0.1 > abs(drops["c"])


def test_some_megabytes_are_trained_on_in_one_task(spark, frame, monkeypatch):
    """Beyond what the driver holds, but bounded: all epochs in a task, with the weights and validation areas of the other ways."""
    train, val = only(frame, "train"), only(frame, "val")
    args = dict(hidden=(6, 3), epochs=5, rate=0.02, batch_size=40, patience=2, id_col=K.ID)
    driver = N.train_network(train, val, NAMES, **args)
    monkeypatch.setattr(N, "LOCAL_BYTES", 10_000)
    monkeypatch.setattr(N, "chained", lambda *a: pytest.fail("a job a chain"))
    task = N.train_network(train.repartition(3), val, NAMES, **args)
    assert N._flat(task.params) == pytest.approx(N._flat(driver.params), abs=1e-9)
    assert [h["val_auc"] for h in task.config["history"]] == pytest.approx([h["val_auc"] for h in driver.config["history"]], abs=1e-12)
    assert task.config["best_val_auc"] == pytest.approx(driver.config["best_val_auc"])
    y = np.array([0, 1, 1, 0, 1.0])
    assert N.auc_here(np.array([0.1, 0.1, 0.5, 0.5, 0.9]), y) == pytest.approx((2 + 1.5 + 0.5) / 6) and N.auc_here(y, y * 0) is None


def test_fold_medians_take_no_long_form(spark, monkeypatch):
    """Medians without each fold come from passes over the columns, of many values and few, and equal plain ones."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(3000, 3)), 2)
    x[:, 1] = rng.choice([0.0, 1.0, np.nan], 3000)
    x[:, 2] = np.nan
    folds = rng.integers(0, 4, 3000)
    rows = [(i, int(f) if f < 3 else None, *(None if i % 5 == 0 and np.isnan(v) else float(v) for v in r)) for i, (f, r) in enumerate(zip(folds, x))]
    df = spark.createDataFrame(rows, "id long, f int, a double, b double, c double").repartition(3)
    for few in (8192, 50):
        monkeypatch.setattr(Q, "_FEW", few)
        monkeypatch.setattr(Q, "_quantiles", lambda *a: pytest.fail("long form"))
        got = W._medians(df, NAMES, [None, 0, 2], "f")
        expected = [[float(np.nanmedian(c)) if (~np.isnan(c)).any() else 0.0 for c in x[(folds != w) | (folds == 3)].T] for w in (-5, 0, 2)]
        assert got.tolist() == pytest.approx(np.array(expected))


def test_wide_blocks_are_read_a_few_at_a_time(spark, monkeypatch):
    """Readers hold a row group as one array a column, so blocks of megabytes need small row groups."""
    df = spark.range(0, 9000, 1, 1).select((F.col("id") % 2).cast("int").alias("TARGET"), F.rand(1).alias("a"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    monkeypatch.setattr(W, "BLOCK_ROWS", 100)
    try:
        blocks = W._packed(df, ["a"], "TARGET", None, 9000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert blocks.count() == 90
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in blocks.inputFiles()]
    assert max(g.row_group(k).num_rows for g in groups for k in range(g.num_row_groups)) <= W.GROUP_BLOCKS


@pytest.mark.parametrize("local", [0, 10 ** 7])
def test_joint_logistic_fits_have_no_gradient_left(spark, frame, monkeypatch, local):
    monkeypatch.setattr(W, "BLOCK_ROWS", 128)
    monkeypatch.setattr(W, "LOCAL_BYTES", local)
    df = frame.withColumn("f", F.pmod(F.col(K.ID), F.lit(3)).cast("int"))
    designs = [W.Design(f"{m}{C}{k}", tuple(n), C, m, k) for m in W.MODES for C in (0.01, 1.0) for k, n in ((None, NAMES), (1, NAMES[:2]))]
    designs += [W.Design("plain", ("a", "b"), 1.0, scale=False)]
    for d, m in zip(designs, W.fit_logistics(df, designs, fold="f")):
        assert m.converged and m.iterations < 20
        own = df.where("TARGET is not null") if d.without is None else df.where("TARGET is not null and f <> 1")
        x, y = rows_of(own, list(d.features))
        if d.scale:
            med = np.nanmedian(x, axis=0)
            x = np.where(np.isnan(x), med, x)
            assert m.medians == pytest.approx(med) and m.means == pytest.approx(x.mean(axis=0)) and m.deviations == pytest.approx(x.std(axis=0))
            x = (x - x.mean(axis=0)) / x.std(axis=0)
        else:
            keep = ~np.isnan(x).any(axis=1)
            x, y = x[keep], y[keep]
        n, pos = len(y), y.sum()
        w0, w1 = {"balanced": (n / 2 / (n - pos), n / 2 / pos), "pos_weight": (1, (n - pos) / pos), "none": (1, 1)}[d.imbalance]
        p = 1 / (1 + np.exp(-(x @ m.coefficients + m.intercept)))
        miss = np.where(y == 1, w1, w0) * (p - y)
        assert np.abs(x.T @ miss + m.coefficients / d.C).max() < 1e-4 and abs(miss.sum()) < 1e-4
    scored = W.fit_logistics(df, designs[:1], fold="f")[0].score(df)
    assert scored.where("score is null or isnan(score)").count() == 0
    aucs = W.fold_aucs(frame, {"all": NAMES, "c": ["c"]}, k=3).collect()
    assert len(aucs) == 6 and min(r.roc_auc for r in aucs if r.feature_set == "all") > 0.7 > 0.65 > max(r.roc_auc for r in aucs if r.feature_set == "c")
