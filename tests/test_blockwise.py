"""Statistics of many columns in one scan: co-moments, counts, order statistics, sketches."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerwise.operators import blockwise as BW
from ledgerwise.operators import profile as P

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 3_000
    a = rng.normal(size=n)
    b = a * 0.5 + rng.normal(size=n) + 1e9
    c = np.where(rng.random(n) < 0.3, 7.0, np.round(rng.exponential(size=n), 2))
    a = np.where(rng.random(n) < 0.1, np.nan, a)
    g = np.where(rng.random(n) < 0.25, None, rng.integers(0, 2, n).astype(object))
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "d": np.full(n, 0.1), "g": g})
    rows = [tuple(None if k == "g" and v is None else v if k == "g" else float(v) for k, v in zip(pdf.columns, r)) for r in pdf.itertuples(index=False)]
    rows = [(None if i % 11 == 0 else r[0], *r[1:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, g int").repartition(7)
    return df, pd.DataFrame(rows, columns=[*COLS, "g"])


def test_correlations_as_pandas_pairs_them(table):
    df, pdf = table
    got = {(r.x, r.y): r.r for r in P.correlation_matrix(df, COLS).collect()}
    want = (pdf[COLS] - [0, 1e9, 0, 0]).corr()  # pandas itself loses digits at 1e9
    for x in COLS:
        for y in COLS:
            w = want.loc[x, y]
            assert got[x, y] is None if "d" in (x, y) else math.isclose(got[x, y], w, abs_tol=1e-9), (x, y, got[x, y], w)


def test_large_means_cost_no_digits(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=2_000)
    y = 0.3 * x + rng.normal(size=2_000)
    df = spark.createDataFrame([(float(p + 1e9), float(q - 1e9)) for p, q in zip(x, y)], "x double, y double").repartition(9)
    got = P.pair_correlations(df, [("x", "y")]).first().r
    assert math.isclose(got, np.corrcoef(x, y)[0, 1], abs_tol=1e-6)


def test_merging_in_levels(table, monkeypatch):
    df, pdf = table
    monkeypatch.setattr(BW, "MERGE_FAN_IN", 2)
    got = BW._read(BW.comoments(df, COLS).first().state, 4)
    both = pdf[COLS].dropna()
    want = ((both["a"] - both["a"].mean()) * (both["b"] - both["b"].mean())).sum()
    assert math.isclose(got[4][0, 1], want, rel_tol=1e-7) and got[0][0, 1] == len(both)


def test_one_scan_for_any_number_of_columns(table, tmp_path, spark):
    df, _ = table
    df.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = P.correlation_matrix(t, COLS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_empty_and_missing(spark):
    none = spark.createDataFrame([], "a double, b double, g int")
    assert [r.r for r in P.pair_correlations(none, [("a", "b")]).collect()] == [None]
    assert P.box_stats(none, ["a"], "g").count() == 0
    gone = spark.createDataFrame([(None, 1.0, 1), (float("nan"), 2.0, 1)], "a double, b double, g int")
    assert [r.r for r in P.pair_correlations(gone, [("a", "b")]).collect()] == [None]
    assert [(r.feature, r.n) for r in P.box_stats(gone, ["a", "b"], "g").collect()] == [("b", 2)]
    with pytest.raises(ValueError):
        P.histogram(gone, ["a"], 5, "g")


@pytest.mark.parametrize("how", [{}, {"grid": 4, "sample_rows": 40, "open_values": 30}, {"grid": 3, "sample_rows": 10, "open_values": 0}])
def test_order_statistics_are_exact(table, how):
    df, pdf = table
    wanted = lambda n: [1, 2, n // 4, n // 4 + 1, n // 2, n - 1, n]
    sizes, found = BW.order_statistics(df, COLS, wanted, "g", **how)
    for g in (None, 0, 1):
        part = pdf[pdf["g"].isna()] if g is None else pdf[pdf["g"] == g]
        for j, c in enumerate(COLS):
            v = np.sort(part[c].dropna().to_numpy())
            assert sizes[g, j] == len(v)
            for p in wanted(len(v)):
                assert found[g, j, p] == v[p - 1], (g, c, p)


def test_a_row_that_holds_a_third(spark):
    """Copies of one row count once in the sample and fully in the counts."""
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    assert len(BW.sample_columns(df, ["v"], rows=100)[0]) < 200
    v = np.sort([5.0 if i % 3 == 0 else float(i) for i in range(3_000)])
    _, found = BW.order_statistics(df, ["v"], lambda n: [5, 6, 1_000, 1_005, 1_006, 2_000], grid=5, sample_rows=50, open_values=10)
    assert all(found[0, 0, p] == v[p - 1] for p in (5, 6, 1_000, 1_005, 1_006, 2_000))


def test_box_stats_keep_the_null_class(table):
    df, pdf = table
    got = {(r.feature, r.g): r for r in P.box_stats(df, ["a", "b", "c"], "g").collect()}
    assert {g for _, g in got} == {None, 0, 1}
    for (c, g), r in got.items():
        v = (pdf[pdf["g"].isna()] if g is None else pdf[pdf["g"] == g])[c].dropna().to_numpy()
        q1, q2, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert np.allclose([r.q1, r.median, r.q3], [q1, q2, q3], rtol=1e-15)
        assert (r.n, r.whisker_lo, r.whisker_hi, r.min, r.max) == (len(v), v[v >= lo].min(), v[v <= hi].max(), v.min(), v.max())
        assert r.outliers == ((v < lo) | (v > hi)).sum()
    plan = P.box_stats(df, ["a", "b", "c"], "g")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") <= 1  # over the groups' rows, after the aggregate


def test_sketch_ranks_stay_within_their_bound(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).cast("double").alias("v"), (F.col("id") % 2).cast("int").alias("g")).repartition(11)
    for r in BW.sketch_quantiles(df, ["v"], [0.1, 0.5, 0.9], "g").collect():
        assert r.n == 25_000
        v = np.sort(df.filter(F.col("g") == r.g).toPandas()["v"].to_numpy())
        for p, q in zip((0.1, 0.5, 0.9), r.quantiles):
            assert abs(np.searchsorted(v, q) / len(v) - p) < 0.002 * 2
    exact, rough = ({(r.feature, r.g): r for r in P.box_stats(df, ["v"], "g", approximate=a).collect()} for a in (False, True))
    assert all(abs(rough[k].median - exact[k].median) < 300 and rough[k].n == exact[k].n for k in exact)


def test_histogram_without_groups_and_with_null_class(table):
    df, pdf = table
    got = P.histogram(df, COLS, 10, None).collect()
    for c in COLS:
        v = pdf[c].dropna().to_numpy()
        n, e = np.histogram(v, 10)
        own = sorted((r.bin, r.count_ if hasattr(r, "count_") else r["count"], r.bin_lo) for r in got if r.feature == c)
        assert [x[1] for x in own] == n.tolist() and np.allclose([x[2] for x in own], e[:-1])
    assert {r.g for r in P.histogram(df, ["c"], 5, "g").collect()} == {None, 0, 1}
