"""Fits of one experiment run side by side, and its silver rows are made once."""
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise import schema as S
from ledgerwise.ml import train as TR
from ledgerwise.ml.registry import Tracker
from ledgerwise.plans import checks as C
from ledgerwise.plans import medallion as MD
from ledgerwise.session import stage_scope
from ledgerwise.sources.lakehouse import Lakehouse

SMALL = {"lr": {"max_iter": 3}, "rf": {"n_estimators": 2, "max_depth": 2}, "gbt": {"n_estimators": 2, "max_depth": 2}}


def silver(spark, n=120):
    cols = ["id", *S.MODEL_FEATURES, "Amount", "Class"]
    x = np.random.default_rng(1).normal(size=(n, len(S.MODEL_FEATURES)))
    return spark.createDataFrame([(i, *map(float, r), float(i), int(r[0] > 0)) for i, r in enumerate(x)],
                                 ", ".join(f"{c} {'int' if c in ('id', 'Class') else 'double'}" for c in cols))


def test_fits_wait_for_each_other(spark, monkeypatch):
    """Every fit has begun before one ends; each run is logged, and their tables go with the job's scope."""
    meet, fit = threading.Barrier(3, timeout=60), TR.fit_pipeline

    def met(*a, **b):
        meet.wait()
        return fit(*a, **b)

    monkeypatch.setattr(TR, "fit_pipeline", met)
    with stage_scope(spark):
        tracker, runs = MD.train_models(Lakehouse.scratch(spark), silver(spark), ("lr", "rf", "gbt"), SMALL)
        files = [f for r in runs for f in r.scored.inputFiles()]
        assert [r.kind for r in runs] == ["lr", "rf", "gbt"] and runs[2].params["n_estimators"] == 2
        assert sorted(r.run_id for r in tracker.runs().collect()) == sorted(r.run_id for r in runs)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(files[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert files and not any(fs.exists(path(f)) for f in files)


def test_runs_beside_a_failed_fit_are_kept(spark):
    """Boosting takes missing features, logistic regression raises: the boosted run is logged and handed on."""
    tracker, df, runs = Tracker(Lakehouse.scratch(spark)), silver(spark).withColumn("V1", F.when(F.col("id") > 3, F.col("V1"))), {}
    with pytest.raises(Exception):
        TR.train_all(df, silver(spark), ("lr", "gbt"), tracker, SMALL, into=runs)
    assert [r.run_id for r in tracker.runs().collect()] == [runs["gbt"].run_id] and len(runs) == 1
    assert TR.train_all(df, df, ()) == []


def test_appended_runs_are_all_kept(spark, monkeypatch):
    """Two runs are never appended at the same time."""
    open_now, most, write = [], [], Lakehouse.write

    def watched(self, df, name, *a, **b):
        if name == S.RUNS:
            open_now.append(1)
            most.append(len(open_now))
        out = write(self, df, name, *a, **b)
        if name == S.RUNS:
            open_now.pop()
        return out

    monkeypatch.setattr(Lakehouse, "write", watched)
    tracker, df = Tracker(Lakehouse.scratch(spark)), silver(spark)
    TR.train_all(df, df, ("lr", "rf"), tracker, SMALL)
    assert most == [1, 1] and tracker.runs().count() == 2


def test_performance_reads_the_silver_rows_of_the_split(spark, tmp_path, monkeypatch):
    x = np.random.default_rng(2).normal(size=(150, 30))
    rows = spark.createDataFrame([(i, [float(v) for v in r], i % 10) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    made, plain = [], C._silver_ml
    monkeypatch.setattr(C, "_silver_ml", lambda *a: made.append(1) or plain(*a))
    e = C._experiment(spark, str(tmp_path), ("lr",))
    monkeypatch.setattr(C, "_experiment", lambda *a: e)
    assert C.q_model_performance(spark, str(tmp_path)).collect()[0].total_scored == 150 and len(made) == 1
    assert e["scores"].select(F.count_distinct("id")).first()[0] == 150
