"""Distributed classifiers, sweeps and tuning.

All trainers are MLlib estimators (distributed by design); the passes of factorization machines and
boosted trees run on blocks of rows (``machines``, ``boosting``), which give the same models. We add what the original sweep lacked: fixed seeds, tree memory scaled with bins x features within a budget, and the feature
frames persisted once for the whole sweep instead of re-transforming the
test split per model.
"""

from __future__ import annotations

import math
import time

from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BlockGBTClassifier
from .evaluate import metric_bundle, score_from_raw
from .machines import BlockFMClassifier
from .tracking import FAILED

SEED = 42
# The swept models' names.
MODEL_NAMES = ("Logistic Regression", "Support Vector Machine", "Factorization Machine",
               "Decision Tree", "Random Forest", "Gradient Boosting Trees")
TREES = MODEL_NAMES[3:]   # take ``FeatureModel.tree_col``
BLOCKWISE = ("Factorization Machine", "Gradient Boosting Trees")   # store their own blocks of rows: a cached frame would only be a second copy


def tree_memory_mb(max_bins: int, n_features: int, n_classes: int = 2, budget_mb: int = 8192) -> int:
    """Room for 64 nodes' bin statistics per pass (MLlib default is 256 MB), within ``budget_mb``.
    Less room means more passes, never another model."""
    per_node = max_bins * max(n_features, 1) * max(n_classes, 2) * 3 * 8
    return int(min(budget_mb, max(256, math.ceil(per_node * 64 / (1 << 20)))))


def estimator(name: str, features_col: str = "features", label_col: str = "label", max_bins: int = 32,
              n_features: int = 1, seed: int = SEED, **overrides):
    """M1-M7 with the original job's effective parameters (plus a seed)."""
    common = {"featuresCol": features_col, "labelCol": label_col}
    trees = {"maxBins": max_bins, "seed": seed, "maxMemoryInMB": tree_memory_mb(max_bins, n_features)}
    if name == "Logistic Regression":
        est = LogisticRegression(**common)
    elif name == "Support Vector Machine":
        est = LinearSVC(**common)
    elif name == "Factorization Machine":
        est = BlockFMClassifier(seed=seed, **common)
    elif name == "Decision Tree":
        est = DecisionTreeClassifier(**common, **trees)
    elif name == "Random Forest":
        # node ids cached between levels (checkpointed every 10 iterations to the shared folder)
        est = RandomForestClassifier(cacheNodeIds=True, **common, **trees)
    elif name == "Gradient Boosting Trees":
        est = BlockGBTClassifier(**common, **trees)
    elif name == "Naive Bayes":
        est = NaiveBayes(**common)
    else:
        raise ValueError(f"unknown model {name!r}")
    if overrides:
        est = est.copy({est.getParam(k): v for k, v in overrides.items()})
    return est


def hyperparams(est) -> dict[str, str]:
    """R2: {param name: value as text} of an estimator or model."""
    return {p.name: str(v) for p, v in est.extractParamMap().items()}


def predict(model, features: DataFrame, keep: list[str]) -> DataFrame:
    """M9: transform and keep (keys, label, prediction, score)."""
    out = model.transform(features)
    if "rawPrediction" in out.columns:
        out = score_from_raw(out)
    elif "score" not in out.columns:   # a given model brings its own
        out = out.withColumn("score", F.col("prediction"))
    return out.select(*keep, "prediction", "score")


def sweep(train: DataFrame, test: DataFrame, names=MODEL_NAMES, label_col: str = "label",
          max_bins: int = 32, n_features: int = 1, seed: int = SEED, tracker=None,
          experiment: str = "sweep", keep: list[str] | None = None, tree_col: str = "features", **overrides):
    """M8: fit, score and evaluate each estimator on ONE persisted pair of feature frames; trees take ``tree_col``.

    Returns {name: (model, metrics dict, seconds)}; with a tracker every run is
    recorded (params, metrics, model artifact), a failing one as FAILED before its
    error is raised. Frames that the caller has persisted stay so.
    """
    keep = keep or [label_col]
    own = [df for df in (train, test) if not df.is_cached]
    for df in own:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    results = {}
    try:
        for name in names:
            est = estimator(name, features_col=tree_col if name in TREES else "features", label_col=label_col, max_bins=max_bins, n_features=n_features, seed=seed,
                            **overrides.get(name, {}))
            run = tracker.start_run(experiment, name) if tracker else None
            t0 = time.time()
            try:
                if tracker:
                    tracker.log_params(run, hyperparams(est))
                model = est.fit(train)
                preds = predict(model, test, keep).persist(StorageLevel.MEMORY_AND_DISK)  # read by two aggregations
                metrics = {r["metric"]: r["value"] for r in metric_bundle(preds, label=label_col).collect()}
                preds.unpersist()
                if tracker:
                    tracker.log_metrics(run, metrics)
                    tracker.log_model(run, model, "model")
            except Exception:
                if tracker:
                    tracker.end_run(run, FAILED)
                raise
            if tracker:
                tracker.end_run(run)
            results[name] = (model, metrics, time.time() - t0)
    finally:
        for df in own:
            df.unpersist()
    return results


def param_grid(est, grid: dict[str, list]) -> list:
    """Cross product of parameter values as MLlib ParamMaps."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), values)
    return builder.build()


def tune(est, grid: list, train: DataFrame, label_col: str = "label", train_ratio: float = 0.8,
         parallelism: int = 1, seed: int = SEED):
    """Single-split tuning on accuracy; the best map is refitted on all of ``train``."""
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction", metricName="accuracy")
    tvs = TrainValidationSplit(estimator=est, estimatorParamMaps=grid, evaluator=ev, trainRatio=train_ratio,
                               parallelism=parallelism, seed=seed, collectSubModels=False)
    return tvs.fit(train)
