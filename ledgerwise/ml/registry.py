"""Experiment runs and model versions kept as tables.

A run is one row (parameters and metrics as maps, the saved model's path);
a registered version is one row ``(name, version, run_id, model_path)``.
Appends are small single-row writes; reads are table scans.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.aggregates import best_row
from ..sources.files import write_artifact_csv
from ..sources.lakehouse import Lakehouse


class Tracker:
    def __init__(self, lake: Lakehouse, experiment: str = S.EXPERIMENT_NAME):
        self.lake = lake
        self.spark = lake.spark
        self.experiment = experiment
        self._append = threading.Lock()  # appends to one table share a commit folder

    # -- runs -------------------------------------------------------------
    def log_run(self, run, run_name: str) -> str:
        path = self.lake.path(f"models/{run.run_id}")
        run.model.write().overwrite().save(path)
        run.model_path = path
        self._log_artifacts(run, path)
        row = (run.run_id, self.experiment, run_name,
               dt.datetime.fromtimestamp(run.started_at, dt.timezone.utc).replace(tzinfo=None),
               {k: str(v) for k, v in run.params.items()},
               {k: (None if v is None else float(v)) for k, v in run.metrics.items()},
               path)
        df = self.spark.createDataFrame([row], S.RUNS_SCHEMA)
        with self._append:
            self.lake.write(df, S.RUNS, mode="append")
        return run.run_id

    def _log_artifacts(self, run, model_path: str) -> None:
        """Confusion matrix and feature importances as CSV next to the model
        (fixed-size frames: 4 cells, one row per feature)."""
        art = model_path.rstrip("/") + "_artifacts"
        if run.confusion is not None:
            write_artifact_csv(run.confusion, f"{art}/confusion_matrix")
        if run.importances:
            imp = self.spark.createDataFrame(run.importances, "feature string, importance double")
            write_artifact_csv(imp, f"{art}/feature_importance")

    def artifact(self, run_id: str, name: str) -> DataFrame:
        path = self.lake.path(f"models/{run_id}_artifacts/{name}")
        return self.spark.read.option("header", "true").option("inferSchema", "true").csv(path)

    def runs(self) -> DataFrame:
        if not self.lake.exists(S.RUNS):
            return self.spark.createDataFrame([], S.RUNS_SCHEMA)
        return self.lake.read(S.RUNS).filter(F.col("experiment") == F.lit(self.experiment))

    def compare_models(self) -> DataFrame:
        """Model type, AUC, precision, recall, F1 per run, best AUC first."""
        r = self.runs()
        return r.select("run_id", F.col("params")["model_type"].alias("model_type"),
                        F.col("metrics")["auc_roc"].alias("auc_roc"),
                        F.col("metrics")["precision"].alias("precision"),
                        F.col("metrics")["recall"].alias("recall"),
                        F.col("metrics")["f1_score"].alias("f1_score"),
                        "started_at") \
            .orderBy(F.col("auc_roc").desc_nulls_last(), F.col("started_at").desc(), "run_id")

    def best_run(self, metric: str = "auc_roc") -> DataFrame:
        r = self.runs().withColumn("_m", F.col("metrics")[metric])
        return best_row(r, "_m").drop("_m")

    # -- registry ---------------------------------------------------------
    def versions(self, name: str = S.MODEL_NAME) -> DataFrame:
        if not self.lake.exists(S.REGISTRY):
            return self.spark.createDataFrame([], S.REGISTRY_SCHEMA)
        return self.lake.read(S.REGISTRY).select(*S.REGISTRY_SCHEMA.names).filter(F.col("name") == F.lit(name))

    def register_best(self, name: str = S.MODEL_NAME, metric: str = "auc_roc") -> dict:
        best = self.best_run(metric).first()
        if best is None:
            raise LookupError("no runs to register")
        version = self._claim_version(name)
        row = (name, version, best["run_id"], best["model_path"],
               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        entry = self.spark.createDataFrame([row], S.REGISTRY_SCHEMA)
        if self.lake.catalog:
            self.lake.write(entry, S.REGISTRY, mode="append")
        else:  # a folder for each version: two jobs that append at once would share one commit folder
            self.lake.write(entry, f"{S.REGISTRY}/entry={uuid.uuid4().hex}")
        return {"name": name, "version": version, "run_id": best["run_id"],
                "model_path": best["model_path"], "model_type": best["params"]["model_type"]}

    def _claim_version(self, name: str) -> int:
        """The next version no other job has: the first, after those in the table, whose
        claim file this job creates."""
        version = int(self.versions(name).agg(F.max("version").alias("v")).first()["v"] or 0) + 1
        while not self.lake.claim(f"{name}/{version}"):
            version += 1
        return version

    def load(self, name: str = S.MODEL_NAME, version: int | None = None) -> tuple[PipelineModel, dict]:
        """A registered version (latest when ``version`` is None)."""
        v = self.versions(name)
        if version is not None:
            v = v.filter(F.col("version") == F.lit(version))
        row = v.orderBy(F.col("version").desc()).limit(1).first()
        if row is None:
            raise LookupError(f"model {name!r} version {version} not registered")
        return PipelineModel.load(row["model_path"]), row.asDict()
