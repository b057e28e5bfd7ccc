"""Permutation importance: true permutations, exact areas by group, a planted useless column."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.ml import importance as I
from ledgerwise.ml import train as TR


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) * 0.3 > 0).astype(int)
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, useless double, Class int").cache()


def test_rows_are_exchanged_by_places(spark, data):
    md5 = lambda s: F.md5(F.concat_ws(":", F.lit(s), F.col("_id").cast("string")))
    got = I.permuted_rows(data, ["a", "b"], keep=["Class"], orders=(md5("t"), md5("g"))).collect()
    base = {r.id: r for r in data.collect()}
    order = lambda s: sorted(base, key=lambda i: (hashlib.md5(f"{s}:{i}".encode()).hexdigest(), i))
    donor = dict(zip(order("t"), order("g")))
    want = {("", i, r.Class, r.a, r.b) for i, r in base.items()}
    want |= {("a", i, r.Class, base[donor[i]].a, r.b) for i, r in base.items()}
    want |= {("b", i, r.Class, r.a, base[donor[i]].b) for i, r in base.items()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_areas_by_group(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 4}", int(rng.integers(0, 2)) if i % 4 else 1, float(np.round(rng.random(), 1))) for i in range(300)]
    rows += [("g1", None, 0.5)]
    got = {r.g: r.auc_roc for r in I.auc_by_group(spark.createDataFrame(rows, "g string, y int, s double"), "g", "y", "s").collect()}
    for g in ("g0", "g1", "g2", "g3"):
        p, n = ([s for h, y, s in rows if h == g and y == c] for c in (1, 0))
        want = sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n)) if p and n else None
        assert got[g] is None if want is None else abs(got[g] - want) < 1e-12


@pytest.mark.parametrize("kind,params", [("lr", {}), ("rf", {"n_estimators": 5, "max_depth": 4}), ("gbt", {"n_estimators": 10, "max_depth": 3})])
def test_useless_column_scores_about_nothing(spark, data, kind, params):
    cols = ["a", "b", "useless"]
    model = TR.fit_pipeline(data, kind, cols, params)
    imp = {r.feature: r.importance for r in I.permutation_importance(model, data, cols).collect()}
    assert list(sorted(imp)) == cols and imp["a"] > imp["b"] > abs(imp["useless"]) and abs(imp["useless"]) < 0.06 and imp["a"] > 0.2


def test_empty_table(spark, data):
    model = TR.fit_pipeline(data, "lr", ["a", "b"], {})
    assert I.permutation_importance(model, data.limit(0), ["a", "b"]).count() == 0


def test_scoring_is_dealt_to_tasks_by_rows(spark, data):
    """1,200 rows of few bytes, 100 to a task; the same rows as in the tasks Spark chooses by bytes."""
    dealt, plain = (I.permuted_rows(data, ["a", "b"], keep=["Class"], task_rows=n) for n in (100, None))
    assert dealt.rdd.getNumPartitions() == 12
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
