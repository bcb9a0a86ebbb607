"""Weighted classifiers on Spark ML with our own preparation, tuning, cross-validation and comparison.

Spark's models reject NaN, so every model brings its train-fitted medians (and scaling for the linear and neural ones).
Frames read by several jobs of one call are persisted for its duration.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize, shared_dir, together
from .boosting import BoostedTrees, fit_cuts, train_boosted_grid
from .forest import Forest, train_forest
from .metrics import areas, choose_threshold, confusion_metrics
from .network import train_network
from .newton import Design, fit_logistics, fold_aucs
from .scaling import ModelInputSpec, fit_model_input
from .splitting import only

FEATURES_COL, WEIGHT_COL = "features", "_weight"


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame on executors while an iterative fit reads it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@dataclass(frozen=True)
class ClassBalance:
    n: int
    pos: int

    @property
    def neg(self) -> int:
        return self.n - self.pos

    @property
    def scale_pos_weight(self) -> float:
        return self.neg / max(self.pos, 1)

    def weight(self, mode: str, target: str = K.TARGET):
        """``balanced`` gives both classes half the total; ``pos_weight`` scales positives only; ``none`` is 1."""
        if mode == "none":
            return F.lit(1.0)
        if mode == "pos_weight":
            return F.when(F.col(target) == 1, self.scale_pos_weight).otherwise(1.0)
        if mode == "balanced":
            w1, w0 = self.n / (2 * max(self.pos, 1)), self.n / (2 * max(self.neg, 1))
            return F.when(F.col(target) == 1, w1).otherwise(w0)
        raise ValueError(f"unknown imbalance mode {mode!r}")


def class_balance(df: DataFrame, target: str = K.TARGET) -> ClassBalance:
    r = df.agg(F.count("*").alias("n"), F.count_if(F.col(target) == 1).alias("p")).first()
    return ClassBalance(r.n, r.p)


@dataclass
class FittedModel:
    """A trained classifier with its preparation; ``pipeline`` is one savable artifact."""

    name: str
    features: list[str]
    pipeline: PipelineModel
    config: dict = field(default_factory=dict)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        scored = self.pipeline.transform(df).withColumn(out, vector_to_array("probability")[1])
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], out)

    @property
    def classifier(self) -> Model:
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)


def preparation(spec: ModelInputSpec, features: Sequence[str], scale: bool = True) -> list:
    """The fitted medians and scaling as Spark ML stages, so that they are stored with the model."""
    parts = []
    for i, c in enumerate(features):
        x = f"coalesce(CAST(`{c}` AS DOUBLE), {spec.medians[c]!r}D)"
        if scale:
            m, s = spec.scaler.stats[c]
            x = f"({x} - ({m!r}D)) / {s!r}D"
        parts.append(f"{x} AS _x{i}")
    select = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
    return [select, VectorAssembler(inputCols=[f"_x{i}" for i in range(len(features))], outputCol=FEATURES_COL)]


def _fit(
    name: str, train: DataFrame, features: Sequence[str], estimator, imbalance: str, target: str, scale: bool,
    spec: ModelInputSpec | None = None, config: dict | None = None, balance: ClassBalance | None = None,
) -> FittedModel:
    """The learners keep their own compact copy of the data (instance blocks, tree points), so the frame is not persisted."""
    spec = spec or fit_model_input(train, features)
    stages = preparation(spec, features, scale)
    if balance is None:
        balance = class_balance(train, target) if imbalance != "none" else ClassBalance(0, 0)
    if hasattr(estimator, "setWeightCol"):
        estimator.setWeightCol(WEIGHT_COL)
    estimator.setLabelCol(target).setFeaturesCol(FEATURES_COL)
    prepared = Pipeline(stages=stages).fit(train)
    frame = prepared.transform(train).select(FEATURES_COL, F.col(target).cast("double").alias(target),
                                             balance.weight(imbalance, target).alias(WEIGHT_COL))
    model = estimator.fit(frame)
    return FittedModel(name, list(features), PipelineModel([*prepared.stages, model]),
                       {"imbalance": imbalance, **(config or {})})


def train_logreg(
    train: DataFrame, features: Sequence[str], C: float = 1.0, max_iter: int = 200, imbalance: str = "balanced",
    target: str = K.TARGET, spec: ModelInputSpec | None = None,
) -> FittedModel:
    """Impute, scale, L2 logistic regression.  Spark minimizes the mean loss, so the penalty is ``1 / (C * sum of weights)``."""
    balance = class_balance(train, target)
    total = balance.neg + balance.scale_pos_weight * balance.pos if imbalance == "pos_weight" else balance.n
    lr = LogisticRegression(maxIter=max_iter, regParam=1.0 / (C * max(total, 1)), elasticNetParam=0.0, standardization=False)
    config = {"C": C, "max_iter": max_iter}
    return _fit("logreg", train, features, lr, imbalance, target, True, spec, config, balance)


def train_gbt(
    train: DataFrame, features: Sequence[str], n_trees: int = 300, max_depth: int = 4, learning_rate: float = 0.05,
    imbalance: str = "pos_weight", target: str = K.TARGET, seed: int = K.SEED, spec: ModelInputSpec | None = None,
) -> FittedModel:
    """Boosted trees; every ten rounds the residuals are checkpointed, which cuts the lineage of 300 rounds."""
    _checkpointing(train)
    gbt = GBTClassifier(maxIter=n_trees, maxDepth=max_depth, stepSize=learning_rate, seed=seed, checkpointInterval=10)
    return _fit("gbt", train, features, gbt, imbalance, target, False, spec,
                {"n_trees": n_trees, "max_depth": max_depth, "learning_rate": learning_rate})


def _checkpointing(df: DataFrame) -> None:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))


def train_random_forest(
    train: DataFrame, features: Sequence[str], n_trees: int = 300, max_depth: int | None = 12, min_leaf: int = 20,
    imbalance: str = "balanced", target: str = K.TARGET, seed: int = K.SEED, spec: ModelInputSpec | None = None,
) -> FittedModel:
    """Random forest; ``max_depth=None`` is Spark's limit of 30."""
    if imbalance not in ("balanced", "none"):
        raise ValueError("a random forest takes imbalance 'balanced' or 'none'")
    rf = RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth or 30, minInstancesPerNode=min_leaf, seed=seed)
    return _fit("random_forest", train, features, rf, imbalance, target, False, spec,
                {"n_trees": n_trees, "max_depth": max_depth})


def balanced_copies(df: DataFrame, balance: ClassBalance, target: str = K.TARGET, id_col: str | None = None) -> DataFrame:
    """Repeat positives until the classes weigh alike, for a learner without weights.

    ``neg / pos`` copies on average: the whole part for every positive, one more for a hashed share of them.
    """
    ratio = max(balance.scale_pos_weight, 1.0)
    whole = int(ratio)
    key = F.xxhash64(*([id_col] if id_col else df.columns))
    extra = (F.pmod(key, F.lit(1_000_000)) < int((ratio - whole) * 1_000_000)).cast("int")
    copies = F.when(F.col(target) == 1, F.lit(whole) + extra).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def train_mlp(
    train: DataFrame, val: DataFrame, features: Sequence[str], hidden: tuple[int, ...] = (128, 64),
    iterations: Sequence[int] = (25, 50, 100), imbalance: str = "pos_weight", target: str = K.TARGET, seed: int = K.SEED,
    patience: int = 3,
) -> FittedModel:
    """Two-layer network.  Early stopping becomes the number of iterations with the best validation AUC; the search ends after
    ``patience`` settings without a better one."""
    if imbalance not in ("pos_weight", "none"):
        raise ValueError("the network takes imbalance 'pos_weight' or 'none'")
    spec = fit_model_input(train, features)
    rows = train if imbalance == "none" else balanced_copies(train, class_balance(train, target), target)
    best, best_auc, waited = None, -1.0, 0
    for n in iterations:
        net = MultilayerPerceptronClassifier(layers=[len(features), *hidden, 2], maxIter=n, seed=seed)
        model = _fit("mlp", rows, features, net, "none", target, True, spec,
                     {"hidden": list(hidden), "iterations": n, "imbalance": imbalance})
        auc = areas(model.score(val), "score", target=target).first().roc_auc
        if auc > best_auc:
            best, best_auc, waited = model, auc, 0
            continue
        waited += 1
        if waited >= patience:
            break
    best.config["best_val_auc"] = best_auc
    return best


# ---------------------------------------------------------------------------------------------------------------------
# tuning, comparison, cross-validation
# ---------------------------------------------------------------------------------------------------------------------

Trainer = Callable[..., FittedModel]

GRIDS: dict[str, tuple[Trainer, list[dict]]] = {
    "logreg": (train_logreg, [{"C": c} for c in (0.1, 1.0, 10.0)]),
    "random_forest": (train_random_forest, [{"max_depth": d} for d in (8, 12, None)]),
    "gbt": (train_gbt, [{"max_depth": d, "learning_rate": r} for d in (4, 6) for r in (0.05, 0.1)]),
}


def evaluate(model: FittedModel, df: DataFrame, threshold: float | None = None, target: str = K.TARGET) -> dict:
    """AUCs and threshold metrics on one slice; the threshold is chosen there when not given.  Never refits."""
    with held(model.score(df).select(target, "score")) as scored:
        t = threshold if threshold is not None else choose_threshold(scored, "score", target=target).first().threshold
        a = areas(scored, "score", target=target).first()
        c = confusion_metrics(scored, "score", t, target=target).first()
    return {"roc_auc": a.roc_auc, "pr_auc": a.pr_auc, "threshold": t, **c.asDict()}


def tune(
    family: str, train: DataFrame, val: DataFrame, features: Sequence[str], target: str = K.TARGET,
    grid: list[dict] | None = None, parallelism: int = 2, **fixed,
) -> tuple[FittedModel, DataFrame]:
    """Best model by (validation AUC, F1) and the trial table.

    Each setting is fitted once and re-thresholded; medians and scaling are fitted once for the whole grid; trials are
    submitted from a few driver threads so that Spark overlaps their stages.
    """
    trainer, default_grid = GRIDS[family]
    spec = fit_model_input(train, features)

    def trial(setting: dict) -> tuple[FittedModel, dict]:
        model = trainer(train, features, target=target, spec=spec, **{**fixed, **setting})
        return model, evaluate(model, val, target=target)

    with ThreadPool(parallelism) as pool:
        done = pool.map(trial, grid or default_grid)
    best = max(done, key=lambda d: (d[1]["roc_auc"], d[1]["f1"]))[0]
    rows = [
        Row(family=family, trial=i, setting=str({**fixed, **s}), **{k: float(m[k]) for k in (
            "roc_auc", "pr_auc", "threshold", "precision", "recall", "f1", "accuracy")}, best=model is best)
        for i, (s, (model, m)) in enumerate(zip(grid or default_grid, done, strict=True))
    ]
    return best, train.sparkSession.createDataFrame(rows)


def score_all(models: Sequence[FittedModel], df: DataFrame, keys: Sequence[str] = (K.SPLIT, K.TARGET)) -> DataFrame:
    """(keys, model, score) long form; every model scores every row once."""
    out = df
    for m in models:
        out = m.score(out, f"_s_{m.name}")
    wide = out.select(*keys, *[F.col(f"_s_{m.name}").alias(m.name) for m in models])
    return wide.unpivot(list(keys), [m.name for m in models], "model", "score")


def cross_validated_auc(
    df: DataFrame, feature_sets: dict[str, Sequence[str]], k: int = 5, id_col: str = K.ID, target: str = K.TARGET,
    seed: int = K.SEED, C: float = 1.0, imbalance: str = "none",
) -> DataFrame:
    """(feature_set, fold, roc_auc): medians, scaling and logistic model fitted on the other folds only, all of them in the same scans."""
    return fold_aucs(df, feature_sets, k, id_col, target, seed, C, imbalance)


def logit_hypotheses(df: DataFrame, designs: dict[str, Sequence[str]], target: str = K.TARGET) -> DataFrame:
    """(model, term, coefficient, roc_auc): in-sample logistic fits on complete rows, all designs in the same scans."""
    models = fit_logistics(df, [Design(name, tuple(terms), scale=False) for name, terms in designs.items()], target)
    scores = F.array(*[F.struct(F.lit(m.name).alias("model"), m.probability().alias("score")) for m in models])
    scored = df.select(target, F.explode(scores).alias("s")).select(target, "s.*").where("score is not null")
    auc = {r.model: r.roc_auc for r in areas(scored, "score", ["model"], target).collect()}
    rows = [(m.name, t, float(c), auc.get(m.name)) for m in models for t, c in zip(m.features, m.coefficients, strict=True)]
    return df.sparkSession.createDataFrame(rows, "model string, term string, coefficient double, roc_auc double")


def tune_all(train: DataFrame, val: DataFrame, features: Sequence[str], id_col: str = K.ID, target: str = K.TARGET, n_trees: int = 300,
             grids: dict[str, list[dict]] | None = None) -> tuple[list, DataFrame]:
    """The grids of all families: fitted models and one row a trial, the best of its family and the winner of all marked.

    Logistic penalties share their scans, as do the settings of the boosted trees; families are fitted at the same time.  Each trial's threshold is chosen on the validation rows; all
    trials are scored and measured together.  Best is by validation AUC, then F1.
    """
    grids = grids or FAMILY_GRIDS
    unknown = set(grids) - {"logreg", "gbt", "random_forest", "mlp"}
    if unknown:
        raise ValueError(f"unknown family {sorted(unknown)[0]!r}")
    cuts = fit_cuts(train, features) if {"gbt", "random_forest"} & set(grids) else None

    def fitted(family: str) -> list:
        grid = grids[family]
        if family == "logreg":
            return fit_logistics(train, [Design(f"C{g['C']}", tuple(features), g["C"], "balanced") for g in grid], target)
        if family == "gbt":
            return train_boosted_grid(train, features, grid, n_trees, target, cuts=cuts)
        if family == "random_forest":
            return [train_forest(train, features, n_trees=n_trees, target=target, id_col=id_col, cuts=cuts, **g) for g in grid]
        return together(*[partial(train_network, train, val, features, target=target, id_col=id_col, **g) for g in grid])

    first = sorted(grids, key=lambda family: family == "random_forest")  # its many tasks go after the few long ones
    by_family = dict(zip(first, together(*[partial(fitted, family) for family in first])))
    models = [m for family in grids for m in by_family[family]]
    rows = [(family, i, str(g)) for family, grid in grids.items() for i, g in enumerate(grid)]
    report = trial_report(models, val, target)
    named = train.sparkSession.createDataFrame([(str(k), *r) for k, r in enumerate(rows)], "model string, family string, trial int, setting string")
    best = lambda by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("roc_auc"), F.desc("f1"), "family", "trial")) == 1
    # one row a trial
    return models, named.join(report, "model").drop("model").withColumns({"best": best(["family"]), "winner": best([F.lit(0)])})


#: the documented grids
FAMILY_GRIDS: dict[str, list[dict]] = {
    "logreg": [{"C": c} for c in (0.1, 1.0, 10.0)],
    "random_forest": [{"max_depth": d} for d in (8, 12, None)],
    "gbt": [{"max_depth": d, "learning_rate": r} for d in (4, 6) for r in (0.05, 0.1)],
    "mlp": [{"hidden": h, "epochs": 12} for h in ((64, 32), (128, 64))],
}


def trial_report(models: Sequence, df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """(model, areas, chosen threshold and its metrics) of each model, by its position; one scoring and one set of curves for all."""
    out = df.select(target, *sorted({f for m in models for f in m.features}))
    for k, m in enumerate(models):
        out = m.score(out, f"_s{k}")
    wide = out.select(target, *[F.col(f"_s{k}").alias(str(k)) for k in range(len(models))])
    scored = materialize(wide.unpivot([target], [str(k) for k in range(len(models))], "model", "score"))
    t = choose_threshold(scored, "score", ["model"], target).select("model", "threshold")
    c = confusion_metrics(scored.join(F.broadcast(t), "model"), "score", F.col("threshold"), ["model"], target)  # one row a model
    a = areas(scored, "score", ["model"], target).select("model", "roc_auc", "pr_auc")
    return a.join(t, "model").join(c, "model").select("model", "roc_auc", "pr_auc", "threshold", "precision", "recall", "f1", "accuracy")


def importances(model: FittedModel | BoostedTrees | Forest, out: str) -> DataFrame:
    """(feature, importance) of a tree model; one row per feature."""
    if isinstance(model, (BoostedTrees, Forest)):
        rows = list(model.importances().items())
    else:
        values = model.classifier.featureImportances.toArray()
        rows = [(f, float(v)) for f, v in zip(model.features, values, strict=True)]
    return SparkSession.getActiveSession().createDataFrame(rows, f"feature string, {out} double")


def refit_winner(model: FittedModel, df: DataFrame, trainer: Trainer, target: str = K.TARGET, **settings) -> FittedModel:
    """Fit the winning setting again on train and validation rows."""
    return trainer(only(df, "train", "val"), model.features, target=target, **settings)
