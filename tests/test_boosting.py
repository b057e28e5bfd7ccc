"""Boosted trees: splits against a brute-force tree, tasks, evaluation history, saving."""
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from ledgerwise.ml import boosting as B

COLS = ["a", "b", "c"]


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = ((x[:, 0] * x[:, 1] > 0.2) | (x[:, 2] > 1)).astype(int)
    return x, np.where(rng.random(n) < 0.05, 1 - y, y)


def frame(spark, x, y):
    return spark.createDataFrame([(int(i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, Class int")


def brute_tree(x, g, h, p, borders, depth=0):
    """Every border of every feature tried on every node, by plain sums."""
    total = (g.sum(), h.sum())
    score = lambda a, b: a * a / (b + p.reg_lambda)
    best = None
    if depth < p.max_depth:
        for f in range(x.shape[1]):
            for cut in [-math.inf] + borders[f]:
                left = ~(x[:, f] > cut)
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = total[0] - gl, total[1] - hl
                gain = 0.5 * (score(gl, hl) + score(gr, hr) - score(*total)) - p.gamma
                if hl >= p.min_child_weight and hr >= p.min_child_weight and gain > 1e-12 and (best is None or gain > best[0] + 1e-10):
                    best = (gain, f, cut, left)
    if best is None:
        return -p.learning_rate * total[0] / (total[1] + p.reg_lambda)
    _, f, cut, left = best
    return f, cut, brute_tree(x[left], g[left], h[left], p, borders, depth + 1), brute_tree(x[~left], g[~left], h[~left], p, borders, depth + 1)


def as_nested(t, i=0):
    if t["feature"][i] < 0:
        return t["value"][i]
    cut = -math.inf if t["border"][i] is None else t["border"][i]
    return t["feature"][i], cut, as_nested(t, t["left"][i]), as_nested(t, t["left"][i] + 1)


def apply(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3]) if isinstance(a, tuple) else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("tasks", [1, 2])
def test_trees_equal_brute_force(spark, tasks):
    x, y = rows(200)
    x[::17, 1] = np.nan
    p = B.BoostParams(n_estimators=3 if tasks == 1 else 1, max_depth=3, max_bins=16)
    df = frame(spark, x, y)
    model = B.fit_boosted(df, COLS, "Class", p, tasks=tasks)
    borders = B.bin_borders(df, COLS, 16)
    body = model.body
    assert math.isclose(body["prior"], math.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), body["prior"])
    for t in body["trees"]:
        prob = 1 / (1 + np.exp(-margin))
        want = brute_tree(x, prob - y, prob * (1 - prob), p, borders)
        assert same(as_nested(t), want)
        margin += [apply(want, r) for r in x]
    assert np.allclose(B._Forest(model.text).margins(x), margin)


def test_jobs_tasks_and_partitions_give_one_model(spark):
    x, y = rows(300, 1)
    df = frame(spark, x, y)
    p = B.BoostParams(n_estimators=4, max_depth=3, max_bins=16)
    whole = B.fit_boosted(df, COLS, "Class", p, tasks=1).body
    assert B.fit_boosted(df.repartition(7), COLS, "Class", p, tasks=1).body == whole
    cut = B.fit_boosted(df, COLS, "Class", p, tasks=1, rounds_per_job=3).body
    assert [t["feature"] for t in cut["trees"]] == [t["feature"] for t in whole["trees"]]
    assert np.allclose([r[1] for r in cut["history"]], [r[1] for r in whole["history"]])


def test_history_is_that_of_the_staged_models(spark):
    x, y = rows(400, 2)
    df = frame(spark, x, y)
    train, held = df.filter("id < 300"), df.filter("id >= 300")
    model = B.fit_boosted(train, COLS, "Class", B.BoostParams(n_estimators=12, max_depth=3), evaluation=held, tasks=1)
    assert [h["round"] for h in model.history] == list(range(1, 13))
    for n in (1, 6, 12):
        m = B._Forest(model.rounds(n).text).margins(x)
        for part, name in ((slice(0, 300), "train"), (slice(300, 400), "eval")):
            loss = np.mean(np.logaddexp(0, np.where(y[part] > 0, -m[part], m[part])))
            assert math.isclose(model.history[n - 1][f"{name}_log_loss"], loss, rel_tol=1e-9)
            b = np.minimum((1 / (1 + np.exp(-m[part])) * B.METRIC_BINS).astype(int), B.METRIC_BINS - 1)
            pos, ap = y[part].sum(), 0.0
            for v in set(b):
                above = b >= v
                ap += y[part][b == v].sum() / pos * y[part][above].sum() / above.sum()
            assert math.isclose(model.history[n - 1][f"{name}_auc_pr"], ap, rel_tol=1e-9)
    losses = [h["train_log_loss"] for h in model.history]
    assert all(a >= b for a, b in zip(losses, losses[1:])) and model.history[-1]["eval_auc_pr"] > y[300:].mean()


def test_pipeline_saves_and_loads(spark, tmp_path):
    x, y = rows(200, 3)
    df = frame(spark, x, y)
    boosted = B.fit_boosted(df, COLS, "Class", B.BoostParams(n_estimators=5, max_depth=3))
    model = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="features"), boosted]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    a, b = (sorted((r.id, r.prediction, tuple(r.probability)) for r in m.transform(df).collect()) for m in (model, back))
    assert a == b
    want = B._Forest(boosted.text).margins(x)
    assert np.allclose([r[2][1] for r in a], 1 / (1 + np.exp(-want))) and all((r[1] == 1.0) == (r[2][1] > 0.5) for r in a)
    assert back.stages[-1].history == boosted.history
    imp = boosted.featureImportances
    assert len(imp) == 3 and (imp >= 0).all() and math.isclose(imp.sum(), 1.0)


def test_odd_inputs(spark):
    schema = "a double, b double, c double, Class int"
    none = spark.createDataFrame([], schema)
    m = B.fit_boosted(none, COLS, "Class", B.BoostParams(n_estimators=2))
    assert [t["feature"] for t in m.body["trees"]] == [[-1], [-1]]
    one = spark.createDataFrame([(1.0, None, 2.0, 1), (1.0, None, 2.0, 1), (3.0, None, None, None)], schema)
    m = B.fit_boosted(one, COLS, "Class", B.BoostParams(n_estimators=2))
    assert [len(t["feature"]) for t in m.body["trees"]] == [1, 1] and m.featureImportances.tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        B.fit_boosted(one, COLS, "Class", B.BoostParams(max_bins=300))


def test_sums_of_the_heavier_child_are_the_rest(monkeypatch):
    """Of two children one is summed, the last level not at all: half the rows a level, and the same histograms."""
    rng = np.random.default_rng(5)
    codes, y = rng.integers(1, 9, (4, 2000)).astype(np.uint8), rng.integers(0, 2, 2000).astype(float)
    g, h = (B.rounded(v, 2000) for v in (0.3 - y, np.full(2000, 0.21)))
    summed, plain = [], B._histograms

    def watched(codes, node, *rest):
        summed.append((node >= 0).sum())
        return plain(codes, node, *rest)

    monkeypatch.setattr(B, "_histograms", watched)
    tree, step = B.grow(codes, g, h, B.BoostParams(max_depth=5), 9, lambda x: x)
    assert len(summed) == 5 and summed[0] == 2000 and all(n <= 1000 for n in summed[1:])
    assert np.array_equal(step, B.leaf_values(tree, codes))
    for i, v in enumerate(tree.value):  # any order of the rows sums to the same bits
        rows = reached(tree, codes, i)
        again = rng.permutation(rows)
        assert g[rows].sum() == g[again].sum() and v == -0.1 * g[rows].sum() / (h[rows].sum() + 1.0)


def reached(tree, codes, node):
    out, todo = np.zeros(codes.shape[1], bool), [(0, np.arange(codes.shape[1]))]
    while todo:
        i, rows = todo.pop()
        if i == node:
            out[rows] = True
        if tree.feature[i] >= 0:
            right = codes[tree.feature[i], rows] > tree.border[i]
            todo += [(tree.left[i], rows[~right]), (tree.left[i] + 1, rows[right])]
    return np.flatnonzero(out)


def test_histograms_add_g_and_h_in_one_pass(monkeypatch):
    rng = np.random.default_rng(6)
    codes, g, h = rng.integers(0, 9, (3, 500)).astype(np.uint8), rng.integers(-8, 9, 500) / 8, rng.integers(0, 3, 500) / 8
    monkeypatch.setattr(B, "CHUNK_ROWS", 64)
    passes, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: passes.append(1) or plain(*a, **b))
    for node in (np.zeros(500, int), rng.integers(-1, 4, 500)):
        got, want = B._histograms(codes, node, 4, g, h, 9), np.zeros((2, 4, 3, 9))
        for r in np.flatnonzero(node >= 0):
            for f in range(3):
                want[:, node[r], f, codes[f, r]] += g[r], h[r]
        assert np.array_equal(got, want) and not passes
