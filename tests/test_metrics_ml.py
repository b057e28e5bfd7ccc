import math

import numpy as np
from pyspark.sql import functions as F

from ledgerwise.ml import scale, split
from ledgerwise.operators import metrics as M


def _df(spark, ys, ss):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(ys, ss)], "Class int, score double")


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(ys, ss):
    order = sorted(set(ss), reverse=True)
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_auc_edge_cases(spark):
    assert M.auc_roc(_df(spark, [0, 1, 0, 1], [0.5] * 4)).first().auc_roc == 0.5
    assert M.auc_roc(_df(spark, [1, 1], [0.2, 0.4])).first().auc_roc is None
    assert M.auc_roc(_df(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first().auc_roc == 1.0
    assert M.auc_roc(_df(spark, [1, 1, 0, 0], [0.1, 0.2, 0.8, 0.9])).first().auc_roc == 0.0


def test_ap_edge_cases(spark):
    assert M.average_precision(_df(spark, [0, 1, 0, 1, 1], [0.5] * 5)).first().average_precision == 0.6
    assert M.average_precision(_df(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first().average_precision == 1.0


def test_ranking_metrics_random_against_brute_force(spark):
    rng = np.random.default_rng(7)
    ys = rng.integers(0, 2, 300).tolist()
    ss = np.round(rng.random(300), 2).tolist()   # many ties
    df = _df(spark, ys, ss)
    assert math.isclose(M.auc_roc(df).first().auc_roc, _brute_auc(ys, ss), rel_tol=1e-12)
    assert math.isclose(M.average_precision(df).first().average_precision, _brute_ap(ys, ss), rel_tol=1e-12)


def test_roc_points_start_and_end(spark):
    pts = M.roc_points(_df(spark, [0, 1, 0, 1], [0.1, 0.4, 0.35, 0.8])).collect()
    pts = sorted(pts, key=lambda r: -r.threshold)
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0) and math.isinf(pts[0].threshold)
    assert (pts[-1].fpr, pts[-1].tpr) == (1.0, 1.0)


def test_precision_zero_when_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "Class int, prediction int")
    m = M.classification_metrics(df).first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1_score == 0.0 and m.accuracy == 0.5
    cm = {(r.actual, r.predicted): r["count"] for r in M.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "c double, x double")
    out = scale.zscore(df, ["c", "x"]).collect()
    assert [r.c for r in out] == [0.0, 0.0]
    assert sorted(r.x for r in out) == [-1.0, 1.0]   # population std


def test_stratified_split_exact_sizes(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(
        F.col("event_id").alias("id"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Class"))
    s = split.stratified_split(df, 0.2, 42).cache()
    got = {(r.split, r.Class): r["count"] for r in s.groupBy("split", "Class").count().collect()}
    n1 = df.filter("Class = 1").count()
    n0 = df.count() - n1
    assert got[("test", 1)] == int(0.2 * n1 + 0.5) and got[("test", 0)] == int(0.2 * n0 + 0.5)
    # the same rows after a repartition
    s2 = split.stratified_split(df.repartition(5), 0.2, 42)
    a = {r.id for r in s.filter("split = 'test'").select("id").collect()}
    b = {r.id for r in s2.filter("split = 'test'").select("id").collect()}
    assert a == b


def test_auc_monotone_invariance_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(11)
    ys = rng.integers(0, 2, 500).tolist()
    ss = np.round(rng.random(500), 3).tolist()
    df = _df(spark, ys, ss)
    a = M.auc_roc(df).first().auc_roc
    b = M.auc_roc(df.withColumn("score", F.exp(F.col("score") * 3) - 7)).first().auc_roc
    assert math.isclose(a, b, rel_tol=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    ref = ev.evaluate(df.withColumn("label", F.col("Class").cast("double")))
    assert math.isclose(a, ref, rel_tol=1e-9)
