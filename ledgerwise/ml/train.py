"""Classifier training on Spark ML with the reference's three model families.

Each model is a ``Pipeline``: population z-score (fitted on the train side)
-> ``VectorAssembler`` -> estimator. Training reads the train side from one
cached frame; evaluation is the aggregate metrics of
``operators.metrics`` on the test side.
"""

from __future__ import annotations

import contextvars
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import metrics as M
from ..session import materialize
from .boosting import BoostParams, fit_boosted
from .forest import ForestParams, fit_forest
from .scale import fit_scaler_stats, scaler_stage

# Reference hyper-parameters (fixed values)
LR_PARAMS = {"C": 1.0, "max_iter": 1000, "tol": 1e-4}
RF_PARAMS = {"n_estimators": 200, "max_depth": 15}
GBT_PARAMS = {"n_estimators": 300, "max_depth": 8, "learning_rate": 0.1}
SEED = 42


def _features_z(cols: Sequence[str]) -> list[str]:
    return [f"{c}_z" for c in cols]


def make_estimator(kind: str, n_train: int, params: dict | None = None, label: str = S.LABEL_COL):
    """Spark ML estimator for ``kind`` in {lr, rf_mllib, gbt_mllib}.

    LR: scikit-learn minimises ``0.5|w|^2 + C * sum(loss)``; Spark minimises
    ``mean(loss) + reg/2 |w|^2``, so ``reg = 1 / (C * n)``.
    """
    p = dict(params or {})
    common = dict(featuresCol="features", labelCol=label)
    if kind == "lr":
        c, it = p.get("C", LR_PARAMS["C"]), p.get("max_iter", LR_PARAMS["max_iter"])
        return LogisticRegression(regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0,
                                  standardization=False, maxIter=it, tol=p.get("tol", 1e-4), **common)
    if kind == "rf_mllib":
        return RandomForestClassifier(numTrees=p.get("n_estimators", RF_PARAMS["n_estimators"]),
                                      maxDepth=p.get("max_depth", RF_PARAMS["max_depth"]),
                                      cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512, seed=p.get("seed", SEED), **common)
    if kind == "gbt_mllib":
        return GBTClassifier(maxIter=p.get("n_estimators", GBT_PARAMS["n_estimators"]),
                             maxDepth=p.get("max_depth", GBT_PARAMS["max_depth"]),
                             stepSize=p.get("learning_rate", GBT_PARAMS["learning_rate"]),
                             seed=p.get("seed", SEED), checkpointInterval=10, **common)
    raise ValueError(f"unknown model kind {kind!r}")


MODEL_TYPES = {"lr": "LogisticRegression", "rf": "RandomForest", "rf_mllib": "RandomForestMLlib", "gbt": "GradientBoostedTrees", "gbt_mllib": "GradientBoostedTreesMLlib"}

PARTITION_BYTES = 64 << 20   # of doubles in one training partition
FOREST_PARTITIONS = 8        # at least, as tree growing is compute-bound per row


def training_partitions(n: int, features: int, kind: str) -> int:
    """Partitions by bytes, the same on every cluster (a forest's bagging depends
    on them)."""
    by_size = -(-n * features * 8 // PARTITION_BYTES)
    return max(FOREST_PARTITIONS if kind in ("rf", "rf_mllib") else 1, by_size)


@dataclass
class TrainBase:
    """What all fits on one training side share: row count and scaler statistics,
    from one aggregate."""
    n: int
    stats: dict

    @staticmethod
    def of(train: DataFrame, features: Sequence[str] = S.MODEL_FEATURES) -> "TrainBase":
        return TrainBase(train.count(), fit_scaler_stats(train, features))


def fit_pipeline(train: DataFrame, kind: str, features: Sequence[str] = S.MODEL_FEATURES,
                 params: dict | None = None, label: str = S.LABEL_COL, base: TrainBase | None = None,
                 evaluation: DataFrame | None = None) -> PipelineModel:
    """One cached copy of the training columns, in partitions of a set size.
    A forest (``forest``) writes the coded rows instead. Boosted trees (``boosting``) code the rows in their own tasks and take
    ``evaluation`` rows, whose metrics they keep for each round."""
    base = base or TrainBase.of(train, features)
    if kind == "gbt":
        return _fit_boosted(train, features, params, label, base, evaluation)
    if kind == "rf":
        return _fit_forest(train, features, params, label, base)
    rows = train.select(*features, label).repartition(training_partitions(base.n, len(features), kind)).cache()
    assembler = VectorAssembler(inputCols=_features_z(features), outputCol="features",
                                handleInvalid="error")
    est = make_estimator(kind, base.n, params, label)
    try:
        return Pipeline(stages=[scaler_stage(base.stats), assembler, est]).fit(rows)
    finally:
        rows.unpersist()


def _fit_boosted(train, features, params, label, base: TrainBase, evaluation) -> PipelineModel:
    p = {**GBT_PARAMS, **(params or {})}
    known = {k: v for k, v in p.items() if k in BoostParams.__dataclass_fields__}
    scaler, cols = scaler_stage(base.stats), _features_z(features)
    model = fit_boosted(scaler.transform(train.select(*features, label)), cols, label, BoostParams(**known), n_rows=base.n,
                        evaluation=None if evaluation is None else scaler.transform(evaluation.select(*features, label)),
                        rounds_per_job=p.get("rounds_per_job"))
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")
    return PipelineModel(stages=[scaler, assembler, model])


def _fit_forest(train, features, params, label, base: TrainBase) -> PipelineModel:
    p = {**RF_PARAMS, **(params or {})}
    known = {k: v for k, v in p.items() if k in ForestParams.__dataclass_fields__}
    scaler, cols = scaler_stage(base.stats), _features_z(features)
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")
    # by way of the vector, which missing features don't get into
    rows = assembler.transform(scaler.transform(train.select(*features, label))).select(label, vector_to_array("features").alias("_x"))
    model = fit_forest(rows.select(label, *[F.get("_x", F.lit(i)).alias(c) for i, c in enumerate(cols)]), cols, label, ForestParams(**known),
                       training_partitions(base.n, len(features), "rf"))
    return PipelineModel(stages=[scaler, assembler, model])


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("id", "Amount", "Class"),
            digits: int = 6) -> DataFrame:
    """``fraud_prediction`` (0/1 at 0.5, long) and ``fraud_probability``
    (class-1 probability, rounded half-even to ``digits``)."""
    out = model.transform(df)
    return out.select(*keep,
                      F.col("prediction").cast("long").alias("fraud_prediction"),
                      F.bround(vector_to_array("probability")[1], digits).alias("fraud_probability"),
                      vector_to_array("probability")[1].alias("_p_raw"))


def evaluate(scored: DataFrame, label: str = S.LABEL_COL) -> dict[str, float]:
    """accuracy, precision, recall, f1, AUC and average precision on the
    unrounded probability; three small aggregate jobs."""
    m = M.classification_metrics(scored, label, "fraud_prediction").first().asDict()
    st = M.score_table(scored, label, "_p_raw")
    auc, ap = (f(st).first()[0] for f in (M.auc_of, M.average_precision_of))
    return {"accuracy": m["accuracy"], "precision": m["precision"], "recall": m["recall"],
            "f1_score": m["f1_score"], "auc_roc": auc, "avg_precision": ap}


def feature_importance(model: PipelineModel, features: Sequence[str] = S.MODEL_FEATURES) -> list[tuple[str, float]]:
    """``(feature, importance)`` descending, for tree models."""
    est = model.stages[-1]
    if not hasattr(est, "featureImportances"):
        return []
    imp = est.featureImportances
    imp = imp.toArray() if hasattr(imp, "toArray") else imp
    return sorted(zip(features, map(float, imp)), key=lambda t: (-t[1], t[0]))


@dataclass
class RunResult:
    run_id: str
    kind: str
    model: PipelineModel
    metrics: dict
    params: dict
    started_at: float
    model_path: str | None = None
    importances: list = field(default_factory=list)
    confusion: DataFrame | None = None
    roc: DataFrame | None = None      # ROC points on the test side
    scored: DataFrame | None = None   # the test side with predictions
    history: list = field(default_factory=list)   # metrics of each boosting round


def train_and_log(train: DataFrame, test: DataFrame, kind: str, tracker=None,
                  params: dict | None = None, features: Sequence[str] = S.MODEL_FEATURES,
                  run_name: str | None = None, base: TrainBase | None = None) -> RunResult:
    """Fit one model, evaluate on ``test``, save it and log one run row."""
    started = time.time()
    defaults = {"lr": LR_PARAMS, "rf": RF_PARAMS, "rf_mllib": RF_PARAMS, "gbt": GBT_PARAMS, "gbt_mllib": GBT_PARAMS}[kind]
    used = {**defaults, **(params or {})}
    model = fit_pipeline(train, kind, features, used, base=base, evaluation=test)
    # written once: six aggregates and the curve read it
    scored = materialize(predict(model, test), "scored")
    mets = evaluate(scored)
    confusion = M.confusion_matrix(scored, S.LABEL_COL, "fraud_prediction")
    roc = M.roc_points(scored, S.LABEL_COL, "_p_raw")
    run = RunResult(run_id=uuid.uuid4().hex, kind=kind, model=model, metrics=mets,
                    params={"model_type": MODEL_TYPES[kind], "n_features": len(features),
                            "resampling": "none", **used},
                    started_at=started, importances=feature_importance(model, features),
                    confusion=confusion, roc=roc, scored=scored, history=getattr(model.stages[-1], "history", []))
    if tracker is not None:
        tracker.log_run(run, run_name or MODEL_TYPES[kind])
    return run


def train_all(train: DataFrame, test: DataFrame, kinds: Sequence[str], tracker=None, params: dict | None = None,
              features: Sequence[str] = S.MODEL_FEATURES, base: TrainBase | None = None, into: dict | None = None) -> list[RunResult]:
    """One run for each kind, in their order. The fits' Spark jobs are submitted side by side: one
    that takes few tasks (boosting within ``TASK_ROWS`` rows takes one) leaves the other slots to the rest.
    ``into`` gets each run by its kind as soon as it is logged, so also those beside one that fails."""
    runs = {} if into is None else into
    base = base or TrainBase.of(train, features)

    def one(kind: str) -> None:
        runs[kind] = train_and_log(train, test, kind, tracker, (params or {}).get(kind), features, base=base)

    with ThreadPoolExecutor(max(len(kinds), 1)) as pool:
        # with the caller's local properties and open stage scopes
        inherit = inheritable_thread_target(train.sparkSession)
        jobs = [pool.submit(inherit(contextvars.copy_context().run), one, k) for k in kinds]
        for j in jobs:
            j.result()
    return [runs[k] for k in kinds]
