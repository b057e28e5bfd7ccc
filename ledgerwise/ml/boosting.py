"""Second-order boosted trees: one Spark job per fit, histograms merged between barrier tasks.

Rows are coded once: each feature's value becomes the number of its quantile
bin (one byte). Every barrier task keeps the codes of its rows and grows all trees, level
by level: it sums gradients and hessians of the log loss by (node, feature, bin), of two children for the
lighter one only, the other's being the rest of their parent's. The tasks gather each other's sums,
so all of them choose the same splits by the regularised gain and only the tree's own rows stay apart. A job per round or
level is not needed, and a fit whose rows take one task needs no gathering at all.

Size: a row takes about 60 bytes beside its codes while it is trained on; ``TASK_ROWS`` rows go to a
task, up to ``MAX_TASKS`` tasks, beyond which tasks hold more rows each (a gathering passes
``tasks**2`` histograms through the driver, so it is their number that is bounded). A
task lost fails the barrier stage, which Spark runs again; ``rounds_per_job`` cuts a long fit into
several jobs, each starting from the trees of those before.

A split sends values up to its border left. Missing values (null, NaN) have a bin of their
own below all others and go left. Ties between splits go to the first feature, then the lowest border.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blockwise

MAX_BINS = 64
TASK_ROWS = 2_000_000
MAX_TASKS = 16
CHUNK_ROWS = 1 << 16      # rows whose histograms are summed at a time
METRIC_BINS = 4_096       # bins of the probability in which the evaluation set is counted


@dataclass
class BoostParams:
    n_estimators: int = 300
    max_depth: int = 8
    learning_rate: float = 0.1
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_bins: int = MAX_BINS


@dataclass
class Tree:
    """Nodes in the order they were made: ``feature`` -1 marks a leaf, ``value`` its output."""
    feature: list = field(default_factory=list)
    border: list = field(default_factory=list)   # number of the last bin that goes left
    left: list = field(default_factory=list)     # the right child follows the left one
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self) -> int:
        for column, x in ((self.feature, -1), (self.border, 0), (self.left, -1), (self.value, 0.0), (self.gain, 0.0)):
            column.append(x)
        return len(self.feature) - 1


# ---------------------------------------------------------------------------
# quantile bins
# ---------------------------------------------------------------------------

def bin_borders(df: DataFrame, cols: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """Rising borders of each column: bin b holds the values up to border b (and above the one
    before). Quantiles whose ranks are counted over all rows; the same on every cluster."""
    return [b.tolist() for b in blockwise.quantile_borders(df, cols, max_bins)]


def code_rows(x: np.ndarray, borders: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of the values, by column; 0 is missing, 1 holds values up to the first border."""
    out = np.empty(x.shape, dtype=np.uint8)
    for j, cuts in enumerate(borders):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(np.asarray(cuts), x[:, j], side="left"))
    return out


# ---------------------------------------------------------------------------
# growing, inside a task
# ---------------------------------------------------------------------------

def _histograms(codes, node, nodes, g, h, bins) -> np.ndarray:
    """(2, nodes, features, bins) sums of g and h; ``node`` is -1 for rows that are left out. One feature at a
    time, so that what is added to stays in the cache; g and h as one complex number, which are added in one pass."""
    out = np.zeros((len(codes), nodes * bins), dtype=np.complex128)
    rows = np.flatnonzero(node >= 0)
    for lo in range(0, len(rows), CHUNK_ROWS):
        own = slice(lo, lo + CHUNK_ROWS) if len(rows) == len(node) else rows[lo:lo + CHUNK_ROWS]
        first, weights = node[own] * bins, g[own] + 1j * h[own]
        for j, column in enumerate(codes):
            np.add.at(out[j], first + column[own], weights)
    out = out.reshape(len(codes), nodes, bins).transpose(1, 0, 2)
    return np.stack([out.real, out.imag])


def best_splits(hist: np.ndarray, p: BoostParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, last bin to the left, gain, sums to the left) of each node; a gain of 0 is no split."""
    total = hist.sum(axis=3)[:, :, 0]
    left = np.cumsum(hist, axis=3)[..., :-1]
    right = total[:, :, None, None] - left

    def value(g, h):
        return g * g / (h + p.reg_lambda)

    gain = 0.5 * (value(*left) + value(*right) - value(*total)[:, None, None]) - p.gamma
    allowed = (left[1] >= p.min_child_weight) & (right[1] >= p.min_child_weight)
    gain = np.where(allowed & (gain > 1e-12), gain, 0.0).reshape(hist.shape[1], -1)
    at = gain.argmax(axis=1)
    rows = np.arange(len(at))
    return at // left.shape[3], at % left.shape[3], gain[rows, at], left.reshape(2, len(at), -1)[:, rows, at]


def rounded(x: np.ndarray, rows: int) -> np.ndarray:
    """Values up to 1 as multiples of a power of two so small that sums over ``rows`` of them are exact. A node's histogram is
    then that of its parent less that of the other child, to the last bit, and no sum depends on the order of rows or tasks."""
    scale = 2.0 ** (52 - max(rows, 1).bit_length())
    return np.rint(x * scale) / scale


def grow(codes: np.ndarray, g: np.ndarray, h: np.ndarray, p: BoostParams, bins: int, merged) -> tuple[Tree, np.ndarray]:
    """One tree and the leaf value of each row. ``codes`` is (features, rows), ``g`` and ``h`` are ``rounded``;
    ``merged`` adds the tasks' histograms. Of two children the lighter one is summed."""
    tree = Tree()
    rows, flat = codes.shape[1], codes.ravel()
    at = np.full(rows, tree.add())                  # the node each row is in
    moving = np.arange(rows)                        # rows that have not ended in a leaf yet
    level = [0]
    hist = merged(_histograms(codes, at, 1, g, h, bins))
    total = hist.sum(axis=3)[:, :, 0]
    for depth in range(p.max_depth + 1):
        for i, node in enumerate(level):
            tree.value[node] = -p.learning_rate * total[0, i] / (total[1, i] + p.reg_lambda)
        if depth == p.max_depth:
            break
        feature, border, gain, left = best_splits(hist, p)
        split = np.flatnonzero(gain > 0)
        if not len(split):
            break
        nxt = []
        for i in split:
            node = level[i]
            tree.feature[node], tree.border[node], tree.gain[node] = int(feature[i]), int(border[i]), float(gain[i])
            tree.left[node] = tree.add()
            nxt += [tree.left[node], tree.add()]
        to = at if len(moving) == rows else at[moving]
        chosen, cut, child = (np.asarray(x) for x in (tree.feature, tree.border, tree.left))
        inner = chosen[to] >= 0
        if not inner.all():
            moving, to = moving[inner], to[inner]
        at[moving] = child[to] + (flat[(chosen * rows)[to] + moving] > cut.astype(codes.dtype)[to])
        left, whole = left[:, split], total[:, split]
        total = np.stack([left, whole - left], axis=2).reshape(2, -1)
        if depth + 1 < p.max_depth:
            light = 2 * np.arange(len(split)) + (total[1, 1::2] < total[1, ::2])
            place = np.full(len(tree.feature), -1)
            place[np.asarray(nxt)[light]] = np.arange(len(split))
            own = merged(_histograms(codes, place[at], len(split), g, h, bins))
            both = np.empty((2, len(nxt), *own.shape[2:]))
            both[:, light], both[:, light ^ 1] = own, hist[:, split] - own
            hist = both
        level = nxt
    return tree, np.asarray(tree.value)[at]


def leaf_values(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """The tree's output for coded rows, given as (features, rows)."""
    feature, border, left = (np.asarray(x) for x in (tree.feature, tree.border, tree.left))
    at = np.zeros(codes.shape[1], dtype=np.int64)
    while True:
        moving = np.flatnonzero(feature[at] >= 0)
        if not len(moving):
            return np.asarray(tree.value)[at]
        to = at[moving]
        at[moving] = left[to] + (codes[feature[to], moving] > border[to])


def _gather(context, own: np.ndarray) -> np.ndarray:
    """The sum of all tasks' arrays, in task order."""
    if context is None:
        return own
    text = base64.b64encode(zlib.compress(own.astype("<f8").tobytes(), 1)).decode()
    out = np.zeros(own.size)
    for part in context.allGather(text):
        out += np.frombuffer(zlib.decompress(base64.b64decode(part)), dtype="<f8")
    return out.reshape(own.shape)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _metrics(margin: np.ndarray, y: np.ndarray, context) -> tuple[float, float]:
    """(mean log loss, average precision over ``METRIC_BINS`` bins of the probability)."""
    loss = np.logaddexp(0, np.where(y > 0, -margin, margin)).sum()
    where = np.minimum((_sigmoid(margin) * METRIC_BINS).astype(np.int64), METRIC_BINS - 1)
    counts = np.stack([np.bincount(where, y, METRIC_BINS), np.bincount(where, 1 - y, METRIC_BINS)])
    sums = _gather(context, np.concatenate((counts.ravel(), [loss, len(y)])))
    pos, neg = (sums[i * METRIC_BINS:(i + 1) * METRIC_BINS][::-1] for i in (0, 1))
    tp, fp = np.cumsum(pos), np.cumsum(neg)
    n = sums[-1]
    if not n:
        return float("nan"), float("nan")
    ap = (pos * tp / np.maximum(tp + fp, 1)).sum() / tp[-1] if tp[-1] else float("nan")
    return float(sums[-2] / n), float(ap)


def boost(codes: np.ndarray, y: np.ndarray, held: np.ndarray, p: BoostParams, bins: int, start: list[Tree], prior: float | None,
          rounds: int, context=None) -> tuple[list[Tree], float, list[tuple]]:
    """(new trees, prior margin, history rows) from one task's rows; ``held`` rows only evaluate."""
    rows, test = np.flatnonzero(~held), np.flatnonzero(held)
    train_codes, test_codes = (np.ascontiguousarray(codes[own].T) for own in (rows, test))
    ty, ey = y[rows], y[test]
    pos, n = _gather(context, np.array([ty.sum(), float(len(ty))]))
    if prior is None:
        share = min(max(pos / max(n, 1.0), 1e-6), 1 - 1e-6)
        prior = float(np.log(share / (1 - share)))
    margin, eval_margin = np.full(len(rows), prior), np.full(len(test), prior)
    for t in start:
        margin += leaf_values(t, train_codes)
        eval_margin += leaf_values(t, test_codes)
    trees, history = [], []
    for r in range(rounds):
        prob = _sigmoid(margin)
        g, h = (rounded(v, int(n)) for v in (prob - ty, prob * (1 - prob)))
        tree, step = grow(train_codes, g, h, p, bins, lambda x: _gather(context, x))
        margin += step
        eval_margin += leaf_values(tree, test_codes)
        trees.append(tree)
        history.append((len(start) + r + 1, *_metrics(margin, ty, context), *_metrics(eval_margin, ey, context)))
    return trees, prior, history


# ---------------------------------------------------------------------------
# fitting
# ---------------------------------------------------------------------------

def fit_boosted(train: DataFrame, features: Sequence[str], label: str, params: BoostParams | None = None,
                evaluation: DataFrame | None = None, tasks: int | None = None, rounds_per_job: int | None = None,
                n_rows: int | None = None, features_col: str = "features") -> "BoostedTreesModel":
    """A fitted transformer. ``evaluation`` rows are scored each round (no early stop).
    ``tasks`` defaults to one for each ``TASK_ROWS`` rows, as far as there are slots."""
    p = params or BoostParams()
    if not 2 <= p.max_bins <= 255:
        raise ValueError("max_bins must lie between 2 and 255")
    cols = list(features)
    spark = train.sparkSession
    numbers = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(cols)]
    known = train.filter(F.col(label).isNotNull()).select(*numbers, F.col(label).cast("double").alias("y"), F.lit(False).alias("held"))
    if tasks is None:
        n = known.count() if n_rows is None else n_rows
        tasks = min(max(1, -(-n // TASK_ROWS)), MAX_TASKS, spark.sparkContext.defaultParallelism)
    borders = bin_borders(known, [f"f{i}" for i in range(len(cols))], p.max_bins)
    bins = max((len(b) for b in borders), default=0) + 2
    rows = known
    if evaluation is not None:
        rows = rows.unionByName(evaluation.filter(F.col(label).isNotNull()).select(
            *numbers, F.col(label).cast("double").alias("y"), F.lit(True).alias("held")))
    # rows of a task in one order, whatever the input's partitions: sums of doubles depend on it
    cells = [f"f{i}" for i in range(len(cols))] + ["y", "held"]
    dealt = rows.repartition(tasks, F.xxhash64(*cells)).sortWithinPartitions(*cells)
    trees: list[Tree] = []
    history: list[tuple] = []
    prior = None
    while len(trees) < p.n_estimators:
        more = min(rounds_per_job or p.n_estimators, p.n_estimators - len(trees))
        got = dealt.mapInArrow(_job(borders, bins, p, trees, prior, more, tasks), "result string", barrier=True).collect()
        if not got:  # no rows, so no tasks: trees without a split
            trees += [Tree([-1], [0], [-1], [0.0], [0.0]) for _ in range(more)]
            continue
        out = json.loads(got[0]["result"])  # trees x nodes, whatever the rows
        trees += [Tree(*t) for t in out["trees"]]
        prior = out["prior"]
        history += [tuple(float("nan") if v is None else v for v in x) for x in out["history"]]
    return BoostedTreesModel.of(trees, borders, prior or 0.0, history, p, len(cols), features_col)


def _job(borders, bins, p, start, prior, rounds, tasks):
    k = len(borders)

    def run(batches):
        context = BarrierTaskContext.get()
        codes, y, held = [np.zeros((0, k), np.uint8)], [np.zeros(0)], [np.zeros(0, bool)]
        for b in batches:
            if b.num_rows:
                x = np.stack([b.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(k)], axis=1)
                codes.append(code_rows(x, borders))
                y.append(b.column(k).to_numpy(zero_copy_only=False))
                held.append(b.column(k + 1).to_numpy(zero_copy_only=False).astype(bool))
        trees, base, history = boost(np.concatenate(codes), np.concatenate(y), np.concatenate(held), p, bins, start, prior, rounds,
                                     context if tasks > 1 else None)
        if context.partitionId() == 0:
            clean = [[None if isinstance(v, float) and np.isnan(v) else v for v in row] for row in history]
            text = json.dumps({"trees": [[t.feature, t.border, t.left, t.value, t.gain] for t in trees], "prior": base, "history": clean})
            yield pa.RecordBatch.from_arrays([pa.array([text])], ["result"])

    return run


# ---------------------------------------------------------------------------
# the fitted model
# ---------------------------------------------------------------------------

class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Scores a vector column: ``probability`` (of both classes) and ``prediction`` (1 above 0.5).
    The trees are one JSON parameter, so the model is saved and loaded within a pipeline."""

    forest = Param(Params._dummy(), "forest", "trees, prior margin, history, number of features", TypeConverters.toString)

    @keyword_only
    def __init__(self, forest="{}", featuresCol="features", predictionCol="prediction", probabilityCol="probability"):
        super().__init__()
        self._setDefault(forest="{}", featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, trees, borders, prior, history, p: BoostParams, n_features: int, features_col: str) -> "BoostedTreesModel":
        flat = []
        for t in trees:
            # a border's value: rows up to it go left; bin 0 (missing) goes left of every border
            value = [borders[f][b - 1] if f >= 0 and b >= 1 else float("-inf") for f, b in zip(t.feature, t.border)]
            flat.append({"feature": t.feature, "border": [v if v > float("-inf") else None for v in value], "left": t.left,
                         "value": t.value, "gain": t.gain})
        body = {"trees": flat, "prior": prior, "features": n_features, "params": vars(p),
                "history": [[None if isinstance(v, float) and np.isnan(v) else v for v in row] for row in history]}
        return cls(forest=json.dumps(body), featuresCol=features_col)

    @property
    def text(self) -> str:
        return self.getOrDefault(self.forest)

    @property
    def body(self) -> dict:
        return json.loads(self.text)

    @property
    def history(self) -> list[dict]:
        """Of each round: log loss and average precision on the training and evaluation rows."""
        names = ("round", "train_log_loss", "train_auc_pr", "eval_log_loss", "eval_auc_pr")
        return [dict(zip(names, row)) for row in self.body["history"]]

    @property
    def featureImportances(self) -> np.ndarray:
        """Total gain of each feature's splits, of all gains (zeros without a split)."""
        body = self.body
        out = np.zeros(body["features"])
        for t in body["trees"]:
            for f, g in zip(t["feature"], t["gain"]):
                if f >= 0:
                    out[f] += g
        return out / out.sum() if out.sum() else out

    def rounds(self, n: int) -> "BoostedTreesModel":
        """The model as it was after ``n`` rounds."""
        body = self.body
        body |= {"trees": body["trees"][:n], "history": body["history"][:n]}
        return BoostedTreesModel(forest=json.dumps(body), featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                 probabilityCol=self.getProbabilityCol())

    def _transform(self, df: DataFrame) -> DataFrame:
        text = self.text

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            forest = _Forest.read(text)
            flat = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, forest.features) if len(x) else np.zeros((0, forest.features))
            return pa.array(forest.margins(flat))

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        out = df.withColumn("_margin", margin(vector_to_array(F.col(self.getFeaturesCol()))))
        return (out.withColumn(self.getProbabilityCol(), array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn(self.getPredictionCol(), F.when(p > 0.5, F.lit(1.0)).otherwise(F.lit(0.0))).drop("_margin"))


class _Forest:
    """The trees as arrays laid end to end."""
    last: tuple[str, "_Forest"] | None = None

    def __init__(self, text: str):
        body = json.loads(text)
        self.features, self.prior = body.get("features", 0), body.get("prior", 0.0)
        trees = body.get("trees", [])
        first = np.concatenate(([0], np.cumsum([len(t["feature"]) for t in trees]))).astype(np.int64)
        self.roots = first[:-1]
        join = lambda name, kind: np.concatenate([np.asarray(t[name], dtype=kind) for t in trees]) if trees else np.zeros(0, kind)
        self.feature, self.value = join("feature", np.int64), join("value", np.float64)
        self.left = join("left", np.int64) + np.repeat(first[:-1], np.diff(first))
        self.border = np.concatenate([[-np.inf if b is None else b for b in t["border"]] for t in trees]).astype(np.float64) if trees else np.zeros(0)
        self.left[self.feature < 0] = np.flatnonzero(self.feature < 0)

    @classmethod
    def read(cls, text: str) -> "_Forest":
        """Parsed once per worker process."""
        if cls.last is None or cls.last[0] != text:
            cls.last = (text, cls(text))
        return cls.last[1]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        step = max(1, (1 << 21) // max(len(self.roots), 1))
        for lo in range(0, len(x), step):
            part = x[lo:lo + step]
            at = np.tile(self.roots, (len(part), 1))
            while len(self.roots):
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                v = np.take_along_axis(part, np.maximum(f, 0), axis=1)
                at = np.where(inner, self.left[at] + (v > self.border[at]), at)
            out[lo:lo + step] += self.value[at].sum(axis=1)
        return out
