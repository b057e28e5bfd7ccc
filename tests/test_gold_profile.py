import math

from pyspark.sql import functions as F

from ledgerwise.operators import aggregates as A
from ledgerwise.operators import profile as P


def test_null_label_counts_in_total_only(spark):
    df = spark.createDataFrame([("Low", 10.0, 1), ("Low", 20.0, 0), ("Low", 30.0, None)],
                               "Amount_category string, Amount double, Class int")
    r = A.fraud_by_amount(df).first()
    assert (r.total_transactions, r.fraud_count, r.legit_count) == (3, 1, 1)
    assert r.fraud_rate_pct == round(100 / 3, 4)
    k = A.kpis(df, stamp=False).first()
    assert k.total_fraud_amount == 10.0 and k.total_transactions == 3


def test_histogram_constant_and_max(spark):
    df = spark.createDataFrame([(0, 5.0)] * 4 + [(1, 0.0), (1, 1.0), (1, 10.0)], "Class int, x double")
    h = {(r.Class, r.bin): r["count"] for r in P.histogram(df, ["x"], 50, "Class").collect()}
    assert sum(1 for k in h if k[0] == 0) == 50 and sum(1 for k in h if k[0] == 1) == 50
    assert h[(0, 26)] == 4          # all equal: range v +- 0.5, value in the middle bin
    import numpy as np
    expect = np.histogram([0.0, 1.0, 10.0], 50)[0]
    assert [h[(1, b)] for b in range(1, 51)] == expect.tolist() and h[(1, 50)] == 1


def test_correlation_constant_and_nan(spark):
    df = spark.createDataFrame([(1.0, 3.0, 0), (2.0, 3.0, 1), (float("nan"), 3.0, 1), (4.0, 3.0, 1)],
                               "a double, c double, Class int")
    got = {r.feature: r.corr for r in P.label_correlation(df, ["a", "c"]).collect()}
    assert got["c"] is None
    import numpy as np
    expect = np.corrcoef([1.0, 2.0, 4.0], [0, 1, 1])[0, 1]
    assert math.isclose(got["a"], expect, rel_tol=1e-12)


def test_box_stats_matches_numpy(spark):
    import numpy as np
    vals = [1.0, 2.0, 2.0, 3.0, 4.0, 100.0, -50.0, 5.0]
    df = spark.createDataFrame([(0, v) for v in vals], "Class int, x double")
    r = P.box_stats(df, ["x"], "Class").first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r.q1, r.median, r.q3) == (q1, med, q3)
    iqr = q3 - q1
    inside = [v for v in vals if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
    assert (r.whisker_lo, r.whisker_hi) == (min(inside), max(inside))
    assert r.outliers == 2


def test_class_distribution(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "Class int")
    got = {r.Class: (r["count"], r.pct) for r in P.class_distribution(df).collect()}
    assert got == {0: (3, 75.0), 1: (1, 25.0)}


def test_best_row_ties(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", 0.9, t0), ("b", 0.9, t0 + dt.timedelta(1)), ("c", None, t0)],
                               "run_id string, auc double, started_at timestamp")
    assert A.best_row(df, "auc").first().run_id == "b"
    df2 = spark.createDataFrame([("c", None, t0), ("d", 0.1, t0)], "run_id string, auc double, started_at timestamp")
    assert A.best_row(df2, "auc").first().run_id == "d"


def test_histogram_matches_numpy_on_edges(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(3.0, 2.0, 3000), rng.exponential(40.0, 2000)])
    lo, hi = vals.min(), vals.max()
    edges = np.linspace(lo, hi, 51)
    vals = np.concatenate([vals, edges[1:-1], np.nextafter(edges[1:-1], -np.inf)])
    df = spark.createDataFrame([(0, float(v)) for v in vals], "Class int, x double")
    got = {r.bin: r["count"] for r in P.histogram(df, ["x"], 50, "Class").collect()}
    expect = np.histogram(vals, 50)[0]
    assert [got[b] for b in range(1, 51)] == expect.tolist()
