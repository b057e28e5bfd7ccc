"""Random forest: splits against plain sums, upper levels by histograms, samples, saving, odd inputs."""
import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from ledgerwise.ml import forest as FO
from ledgerwise.ml import train as TR

COLS = ["a", "b", "c"]


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = ((x[:, 0] * x[:, 1] > 0.2) | (x[:, 2] > 1)).astype(int)
    return x, np.where(rng.random(n) < 0.05, 1 - y, y)


def frame(spark, x, y):
    return spark.createDataFrame([(int(i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, Class int")


def trees(model):
    return FO._Forest(model.trees, model.max_depth).unpacked()


def test_grown_tree_takes_the_best_split_of_the_drawn_features():
    rng = np.random.default_rng(3)
    codes, y, w = rng.integers(0, 6, (400, 5)).astype(np.uint8), rng.integers(0, 2, 400).astype(np.uint8), rng.integers(1, 4, 400).astype(np.uint8)
    p = FO.ForestParams(max_depth=4)
    feature, border, share, importance = FO.grow(codes, y, w, 0, p, 8, (1, 2, 3))
    level, split, gains = [(0, np.arange(400))], 0, np.zeros(5)
    gini = lambda r: w[r].sum() * (1 - np.bincount(y[r], w[r], 2).dot(np.bincount(y[r], w[r], 2)) / w[r].sum() ** 2) if len(r) else 0.0
    seen = 0
    for depth in range(5):
        mixed = [(i, r) for i, r in level if depth < 4 and len(set(y[r])) == 2]
        drawn = dict(zip([i for i, _ in mixed], FO.drawn_features((1, 2, 3, depth), len(mixed), 5))) if mixed else {}
        nxt = []
        for i, r in level:
            seen += 1
            assert np.isclose(share[i], (w[r] * y[r]).sum() / w[r].sum())
            tried = [(gini(r) - gini(r[codes[r, f] <= b]) - gini(r[codes[r, f] > b]), f, b) for f in drawn.get(i, ()) for b in range(7)]
            best = max((t[0] for t in tried), default=0)
            if best <= 1e-9:
                assert feature[i] == -1
                continue
            f, b = feature[i], border[i]
            assert f in drawn[i] and np.isclose(dict(((t[1], t[2]), t[0]) for t in tried)[f, b], best)
            gains[f] += best
            nxt += [(1 + 2 * split, r[codes[r, f] <= b]), (2 + 2 * split, r[codes[r, f] > b])]
            split += 1
        level = nxt
    assert seen == len(feature) and np.allclose(importance, gains)


@pytest.mark.parametrize("local_rows", [40, 10_000])
def test_leaves_hold_the_shares_of_the_sample(spark, monkeypatch, local_rows):
    """Whatever is grown by histograms and whatever in one group: no group is larger, each leaf's share is that of its rows."""
    x, y = rows(600)
    monkeypatch.setattr(FO, "LOCAL_ROWS", local_rows)
    sizes, send = [], FO._send

    def watched(tops, wanted, k, p):
        sizes.append((tops, wanted))
        return send(tops, wanted, k, p)

    monkeypatch.setattr(FO, "_send", watched)
    p = FO.ForestParams(n_estimators=6, max_depth=7, max_bins=16)
    model = FO.fit_forest(frame(spark, x, y), COLS, "Class", p, partitions=1)
    order = np.lexsort((y, x[:, 2], x[:, 1], x[:, 0]))    # one block, sorted by its cells
    sx, sy = x[order], y[order]
    tops, wanted = sizes[0]
    borders = FO.BO.bin_borders(frame(spark, x, y), COLS, 16)
    assert (max(len(t.feature) for t in tops.values()) > 1) == (local_rows == 40)
    for t, (feature, left, value) in enumerate(trees(model)):
        w = np.random.default_rng((p.seed, 0, 0, t)).poisson(1.0, len(sy))
        at, depth = np.zeros(len(sy), int), 0
        while (feature[at] >= 0).any():
            inner = feature[at] >= 0
            at = np.where(inner, left[at] + (sx[np.arange(len(sx)), np.maximum(feature[at], 0)] > value[at]), at)
            depth += 1
        assert depth <= 7
        for leaf in set(at[w > 0]):
            own = at == leaf
            assert np.isclose(value[leaf], (w * sy)[own].sum() / w[own].sum())
        ends = tops[t].place(FO.BO.code_rows(sx, borders))
        for i in wanted.get(t, ()):
            assert w[ends == i].sum() <= local_rows
    assert ((FO._Forest(model.trees, 7).shares(x) > 0.5) == y).mean() > 0.85


def test_row_order_and_saving(spark, tmp_path):
    x, y = rows(300, 1)
    df = frame(spark, x, y)
    p = FO.ForestParams(n_estimators=5, max_depth=5)
    one, two = (FO.fit_forest(d, COLS, "Class", p, partitions=2) for d in (df, df.repartition(7)))
    assert one.trees == two.trees and one.importances == two.importances
    assert np.isclose(sum(one.importances), 1) and min(one.importances) >= 0 and len(one.importances) == 3
    model = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="features"), one]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    a, b = (sorted((r.id, r.prediction, tuple(r.probability)) for r in m.transform(df).collect()) for m in (model, back))
    assert a == b and all((r[1] == 1.0) == (r[2][1] > 0.5) for r in a)
    assert np.allclose([r[2][1] for r in a], FO._Forest(one.trees, 5).shares(x))
    assert back.stages[-1].featureImportances.tolist() == one.featureImportances.tolist()


def test_the_pipeline_grows_it_and_odd_inputs(spark):
    x, y = rows(60, 2)
    model = TR.fit_pipeline(frame(spark, x, y), "rf", COLS, {"n_estimators": 3, "max_depth": 2})
    assert isinstance(model.stages[-1], FO.ForestModel) and len(trees(model.stages[-1])) == 3
    assert TR.feature_importance(model, COLS)[0][1] > 0
    p = FO.ForestParams(n_estimators=2, max_depth=3)
    same = FO.fit_forest(frame(spark, x, np.ones(60)), COLS, "Class", p)
    assert [(t[0].tolist(), t[2].tolist()) for t in trees(same)] == [([-1], [1.0])] * 2 and same.importances == [0, 0, 0]
    with pytest.raises(ValueError):
        FO.fit_forest(frame(spark, x, y).limit(0), COLS, "Class", p)
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        FO.fit_forest(frame(spark, x, y + 1), COLS, "Class", p)


def test_histograms_equal_plain_sums():
    """Of one node and of several, with as many bins as a byte holds, over part of the rows."""
    rng = np.random.default_rng(4)
    codes, y, w = rng.integers(0, 256, (300, 6)).astype(np.uint8), rng.integers(0, 2, 300).astype(np.uint8), rng.integers(1, 4, 300).astype(np.uint8)
    rows = np.sort(rng.choice(300, 200, replace=False))
    for nodes in (1, 3):
        node, chosen = rng.integers(0, nodes, 200), FO.drawn_features((1, nodes), nodes, 6)
        got, want = FO._histograms(codes, rows, node, chosen, y[rows], w[rows], 256), np.zeros((2, nodes, 3, 256))
        for r, i in zip(rows, node):
            for j, f in enumerate(chosen[i]):
                want[0, i, j, codes[r, f]] += w[r]
                want[1, i, j, codes[r, f]] += w[r] * y[r]
        assert np.array_equal(got, want)
