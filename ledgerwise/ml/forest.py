"""Random forests: upper levels by shuffled histograms, what lies below in one group of rows each.

A row costs one byte a feature: the number of its quantile bin. The coded rows are written
once, in blocks; how often a row is in a tree's sample follows from the tree and the row's block, so it is
drawn again wherever it is needed and never stored.

While a node holds more than ``LOCAL_ROWS`` rows of its sample, its split is chosen from histograms
that the tasks sum over their blocks and Spark merges by (tree, node): one job for a level of all trees.
The rows of smaller nodes are shuffled by (tree, node), and each such group grows the rest of its
tree by itself. So no task or group holds more rows than that, a deep level costs no histograms
over the wire, and what is moved is ``features + 2`` bytes for each row and tree.

All sums are whole numbers, so the trees do not depend on the order of rows or tasks. The choices are
those of Spark ML's forest: Poisson(1) samples, Gini gain, the square root of the features for
each node, a node without gain is a leaf; a tree votes with the shares of its leaf. Ties between splits
go to the first feature drawn, then the lowest border. Labels are 0 and 1.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import boosting as BO

MAX_BINS = 32
LOCAL_ROWS = 65_536       # rows (of the sample) below which one group grows the rest of a tree
BLOCK_ROWS = 8_192
OPEN_NODES = 20_000       # whose histograms are summed in one job
CELLS = 1 << 19           # of histograms searched at a time
SEND_BYTES = 8 << 20      # of a batch of shuffled rows


@dataclass
class ForestParams:
    n_estimators: int = 200
    max_depth: int = 15
    seed: int = 42
    max_bins: int = MAX_BINS


@dataclass
class Top:
    """The levels of a tree that were split by histograms; nodes in the order they were made."""
    feature: list = field(default_factory=lambda: [-1])
    border: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def add(self, depth: int, value: float) -> int:
        for column, x in ((self.feature, -1), (self.border, 0), (self.left, -1), (self.value, value), (self.depth, depth)):
            column.append(x)
        return len(self.feature) - 1

    def place(self, codes: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The node each of the (named) rows ends in."""
        feature, border, left = (np.asarray(x) for x in (self.feature, self.border, self.left))
        flat, first = codes.ravel(), (np.arange(len(codes)) if rows is None else rows) * codes.shape[1]
        at = np.zeros(len(first), dtype=np.int64)
        moving = np.arange(len(first)) if feature[0] >= 0 else np.zeros(0, dtype=np.int64)
        while len(moving):
            to = at[moving]
            to = left[to] + (flat[first[moving] + feature[to]] > border[to])
            at[moving] = to
            moving = moving[feature[to] >= 0]
        return at


# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------

def drawn_features(key: Sequence[int], nodes: int, features: int) -> np.ndarray:
    """(nodes, k) distinct features, k the square root of their number, rounded up."""
    k = max(1, math.ceil(math.sqrt(features)))
    return np.argsort(np.random.default_rng(list(key)).random((nodes, features)), axis=1)[:, :k]


def _histograms(codes, rows, node, chosen, y, w, bins) -> np.ndarray:
    """(2, nodes, k, bins): weights of all the rows and of those of class 1 by bin of the node's features. One feature at a
    time, the classes' cells side by side, so that each row is added once and what is added to stays in the cache."""
    nodes, k = chosen.shape
    out = np.empty((k, nodes * bins * 2))
    flat, first, cell = codes.ravel(), rows * codes.shape[1], node * (2 * bins) + y
    for j in range(k):
        code = flat[first + (chosen[0, j] if nodes == 1 else chosen[:, j][node])]
        out[j] = np.bincount(cell + code.astype(np.int64) * 2, w, nodes * bins * 2)
    none, ones = np.moveaxis(out.reshape(k, nodes, bins, 2), (3, 1), (0, 1))
    return np.stack([none + ones, ones])


def best_splits(hist: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each node: (place of the feature, last bin to the left, Gini gain times rows, rows, ones, rows and ones to
    the left); a gain of 0 is no split."""
    total = hist.sum(axis=3)[:, :, 0]
    left = np.cumsum(hist, axis=3)[..., :-1]
    right = total[:, :, None, None] - left

    def purity(n, ones):
        return (ones * ones + (n - ones) * (n - ones)) / np.maximum(n, 1)

    gain = purity(*left) + purity(*right) - purity(*total)[:, None, None]
    gain = np.where((left[0] > 0) & (right[0] > 0) & (gain > 1e-9), gain, 0.0).reshape(hist.shape[1], -1)
    at = gain.argmax(axis=1)
    rows = np.arange(len(at))
    n_left, ones_left = (x.reshape(len(at), -1)[rows, at] for x in left)
    return at // left.shape[3], at % left.shape[3], gain[rows, at], total[0], total[1], n_left, ones_left


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, p: ForestParams, bins: int,
         key: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, border, share, importance) of the tree below a node at ``depth``, from all of its rows. Nodes come level by
    level: the children of the j-th split are 1 + 2j and 2 + 2j; a feature of -1 marks a leaf."""
    k = codes.shape[1]
    importance = np.zeros(k)
    out = []
    w = w.astype(np.float64)
    rows, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
    n, ones = np.array([w.sum()]), np.array([(w * y).sum()])
    while len(n):
        feature, border = np.full(len(n), -1, dtype=np.int64), np.zeros(len(n), dtype=np.int64)
        n_left, ones_left = np.zeros(len(n)), np.zeros(len(n))
        mixed = np.flatnonzero((ones > 0) & (ones < n)) if depth < p.max_depth else np.zeros(0, dtype=np.int64)
        if len(mixed):
            number = np.full(len(n), -1)
            number[mixed] = np.arange(len(mixed))
            node = number[node]
            own = np.flatnonzero(node >= 0)                    # rows of pure nodes are done with
            own = own[np.argsort(node[own].astype(np.uint32), kind="stable")]
            rows, node = rows[own], node[own]
            codes, y, w, rows = codes[rows], y[rows], w[rows], np.arange(len(rows))
            chosen = drawn_features((*key, depth), len(mixed), k)
            step = max(1, CELLS // (chosen.shape[1] * bins))
            for lo in range(0, len(mixed), step):
                own = slice(*np.searchsorted(node, (lo, lo + step)))
                part = chosen[lo:lo + step]
                f, b, gain, _, _, nl, ol = best_splits(_histograms(codes, rows[own], node[own] - lo, part, y[own], w[own], bins))
                f = part[np.arange(len(part)), f]
                to = mixed[lo:lo + step]
                feature[to], border[to], n_left[to], ones_left[to] = np.where(gain > 0, f, -1), b, nl, ol
                importance += np.bincount(f, gain, k)
        out.append((feature, border, ones / np.maximum(n, 1)))
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        child = np.full(len(n), -1)
        child[split] = 2 * np.arange(len(split))
        node = mixed[node]
        own = np.flatnonzero(child[node] >= 0)
        rows, node = rows[own], node[own]
        node = child[node] + (codes[rows, feature[node]] > border[node])
        n = np.stack([n_left[split], n[split] - n_left[split]], axis=1).ravel()
        ones = np.stack([ones_left[split], ones[split] - ones_left[split]], axis=1).ravel()
        depth += 1
    return *(np.concatenate([x[i] for x in out]) for i in range(3)), importance


# ---------------------------------------------------------------------------
# fitting
# ---------------------------------------------------------------------------

def _code(borders: list):
    """Rows as blocks of codes and labels, counted within their partition."""
    k = len(borders)

    def run(batches: Iterator[pa.RecordBatch]):
        part, block, codes, y = TaskContext.get().partitionId(), 0, np.zeros((0, k), np.uint8), np.zeros(0, np.uint8)
        for b in chain(batches, [None]):
            if b is not None and b.num_rows:
                x = np.stack([b.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(k)], axis=1)
                label = b.column(k).to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isin(label, (0, 1)).all():
                    raise ValueError("labels must be 0 or 1")
                codes, y = np.concatenate((codes, BO.code_rows(x, borders))), np.concatenate((y, label.astype(np.uint8)))
            while len(y) >= BLOCK_ROWS or (b is None and len(y)):
                own = slice(0, BLOCK_ROWS)
                yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "n": len(y[own]), "ones": int(y[own].sum()),
                                                   "codes": codes[own].tobytes(), "y": y[own].tobytes()}], _BLOCK_ARROW)
                block, codes, y = block + 1, codes[BLOCK_ROWS:], y[BLOCK_ROWS:]

    return run


_BLOCK = "part int, block int, n long, ones long, codes binary, y binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("ones", pa.int64()), ("codes", pa.binary()), ("y", pa.binary())])
_SPLIT = "tree int, node int, feature int, border int, gain double, n double, ones double, n_left double, ones_left double"
_ROWS = "tree int, node int, codes binary, y binary, w binary"
_GROWN = "tree int, node int, feature binary, border binary, share binary, importance binary"


def _samples(batches, tops: dict[int, Top], k: int, seed: int):
    """(tree, node, codes, y, rows, weights) of each block and tree: the rows in the tree's sample, and where in it they are."""
    for b in batches:
        for part, block, codes, y in zip(*(b.column(c).to_pylist() for c in ("part", "block", "codes", "y"))):
            codes, y = np.frombuffer(codes, np.uint8).reshape(-1, k), np.frombuffer(y, np.uint8)
            for t, top in tops.items():
                w = np.random.default_rng((seed, part, block, t)).poisson(1.0, len(y)).astype(np.uint8)
                rows = np.flatnonzero(w)
                yield t, top.place(codes, rows), codes, y, rows, w[rows]


def _level(tops: dict[int, Top], wanted: dict[int, list[int]], k: int, bins: int, p: ForestParams):
    """The tasks' histograms of the wanted nodes."""
    chosen = {(t, i): drawn_features((p.seed, t, i), 1, k) for t, nodes in wanted.items() for i in nodes}

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for t, node, codes, y, rows, w in _samples(batches, {t: tops[t] for t in wanted}, k, p.seed):
            for i in wanted[t]:
                own = np.flatnonzero(node == i)
                hist = _histograms(codes, rows[own], np.zeros(len(own), np.int64), chosen[t, i], y[rows[own]], w[own], bins)
                sums[t, i] = sums[t, i] + hist if (t, i) in sums else hist
        for (t, i), hist in sums.items():
            yield pa.RecordBatch.from_pylist([{"tree": t, "node": i, "hist": hist.astype("<f8").tobytes()}], _HIST_ARROW)

    def choose(batches):
        for b in batches:
            out = []
            for t, i, parts in zip(*(b.column(c).to_pylist() for c in ("tree", "node", "hists"))):
                own = chosen[t, i]
                hist = sum(np.frombuffer(h, "<f8") for h in parts).reshape(2, 1, own.shape[1], bins)
                f, *rest = (x[0] for x in best_splits(hist))
                out.append((t, i, int(own[0, f]), int(rest[0]), *map(float, rest[1:])))
            yield pa.RecordBatch.from_arrays([pa.array(c, s) for c, s in zip(zip(*out), [pa.int32()] * 4 + [pa.float64()] * 5)], _SPLIT_NAMES)

    return run, choose


_HIST_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("hist", pa.binary())])
_SPLIT_NAMES = [c.split()[0] for c in _SPLIT.split(", ")]
_ROWS_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("codes", pa.binary()), ("y", pa.binary()), ("w", pa.binary())])


def _send(tops: dict[int, Top], wanted: dict[int, list[int]], k: int, p: ForestParams):
    """The rows of the wanted nodes, one record for each block, tree and node."""

    def run(batches):
        ready, size = [], 0
        for t, node, codes, y, rows, w in _samples(batches, {t: tops[t] for t in wanted}, k, p.seed):
            for i in wanted[t]:
                at = np.flatnonzero(node == i)
                if len(at):
                    own = rows[at]
                    ready.append({"tree": t, "node": i, "codes": codes[own].tobytes(), "y": y[own].tobytes(), "w": w[at].tobytes()})
                    size += len(own) * (k + 2)
            if size >= SEND_BYTES:
                yield pa.RecordBatch.from_pylist(ready, _ROWS_ARROW)
                ready, size = [], 0
        if ready:
            yield pa.RecordBatch.from_pylist(ready, _ROWS_ARROW)

    return run


def _grow_group(depths: dict[tuple[int, int], int], k: int, bins: int, p: ForestParams):
    def run(group: pa.Table) -> pa.Table:
        t, i = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        codes, y, w = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.uint8) for c in ("codes", "y", "w"))
        feature, border, share, importance = grow(codes.reshape(-1, k), y, w, depths[t, i], p, bins, (p.seed, t, i))
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([i], pa.int32()), "feature": [feature.astype("<i2").tobytes()],
                         "border": [border.astype(np.uint8).tobytes()], "share": [share.astype("<f8").tobytes()],
                         "importance": [importance.astype("<f8").tobytes()]})

    return run


def fit_forest(train: DataFrame, features: Sequence[str], label: str, params: ForestParams | None = None, partitions: int = 8,
               features_col: str = "features") -> "ForestModel":
    """A fitted transformer. The trees depend on ``partitions`` (the samples are drawn by blocks of them), on nothing else
    of the cluster or the order of the rows."""
    p = params or ForestParams()
    if not 2 <= p.max_bins <= 255:
        raise ValueError("max_bins must lie between 2 and 255")
    spark, k = train.sparkSession, len(features)
    cells = [f"f{i}" for i in range(k)]
    rows = train.select(*[F.col(c).cast("double").alias(f) for c, f in zip(features, cells)], F.col(label).cast("double").alias("y"))
    borders = BO.bin_borders(rows, cells, p.max_bins)
    bins = max((len(b) for b in borders), default=0) + 2
    dealt = rows.repartition(partitions, F.xxhash64(*cells, "y")).sortWithinPartitions(*cells, "y")
    blocks = materialize(dealt.mapInArrow(_code(borders), _BLOCK), "forest-blocks")
    n, ones = blocks.agg(F.sum("n"), F.sum("ones")).first()
    if not n:
        raise ValueError("no rows to train on")
    # blocks are few and dear: each may be a task of its own
    blocks = blocks.repartition(max(1, min(-(-n // BLOCK_ROWS), 4 * spark.sparkContext.defaultParallelism)), "part", "block")
    tops = {t: Top() for t in range(p.n_estimators)}
    for top in tops.values():
        top.value[0] = ones / n
    importance = np.zeros((p.n_estimators, k))
    small: dict[int, list[int]] = {t: [] for t in tops}
    large = [(t, 0) for t in tops] if n > LOCAL_ROWS and p.max_depth > 0 else []
    if not large:
        small = {t: [0] for t in tops}
    while large:
        now, large = large[:OPEN_NODES], large[OPEN_NODES:]
        run, choose = _level(tops, _by_tree(now), k, bins, p)
        sums = blocks.mapInArrow(run, "tree int, node int, hist binary").groupBy("tree", "node").agg(F.collect_list("hist").alias("hists"))
        for r in sums.mapInArrow(choose, _SPLIT).collect():  # at most OPEN_NODES rows
            top, i = tops[r.tree], r.node
            top.value[i] = r.ones / r.n if r.n else ones / n
            if r.gain <= 0:
                continue
            top.feature[i], top.border[i] = r.feature, r.border
            importance[r.tree, r.feature] += r.gain
            for at, (m, m1) in enumerate(((r.n_left, r.ones_left), (r.n - r.n_left, r.ones - r.ones_left))):
                child = top.add(top.depth[i] + 1, m1 / m)
                if at == 0:
                    top.left[i] = child
                if 0 < m1 < m and top.depth[child] < p.max_depth:
                    if m > LOCAL_ROWS:
                        large.append((r.tree, child))
                    else:
                        small[r.tree].append(child)
    wanted = {t: nodes for t, nodes in small.items() if nodes}
    grown: dict[tuple[int, int], tuple] = {}
    if wanted:
        depths = {(t, i): tops[t].depth[i] for t, nodes in wanted.items() for i in nodes}
        tasks = max(1, min(len(depths), 4 * spark.sparkContext.defaultParallelism))
        sent = blocks.mapInArrow(_send(tops, wanted, k, p), _ROWS).repartition(tasks, "tree", "node")
        done = sent.groupBy("tree", "node").applyInArrow(_grow_group(depths, k, bins, p), _GROWN)
        for r in materialize(done, "forest-parts").collect():  # nodes: bounded by trees and depth, whatever the rows
            grown[r.tree, r.node] = tuple(np.frombuffer(x, d) for x, d in ((r.feature, "<i2"), (r.border, np.uint8), (r.share, "<f8")))
            importance[r.tree] += np.frombuffer(r.importance, "<f8")
    trees = [_joined(tops[t], {i: grown[t, i] for i in wanted.get(t, ()) if (t, i) in grown}, borders) for t in tops]
    whole = importance.sum(axis=1, keepdims=True)
    shares = (importance / np.where(whole > 0, whole, 1)).sum(axis=0)
    return ForestModel.of(trees, shares / shares.sum() if shares.sum() else shares, p, features_col)


def _by_tree(nodes: list[tuple[int, int]]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for t, i in nodes:
        out.setdefault(t, []).append(i)
    return out


def _joined(top: Top, grown: dict[int, tuple], borders: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, left child, border or share) of a whole tree: what was grown below a node is laid behind the others, and
    its first node takes that node's place."""
    feature, border, left, value = [np.asarray(top.feature)], [np.asarray(top.border)], [np.asarray(top.left)], [np.asarray(top.value)]
    size = len(top.feature)
    for i, (f, b, share) in grown.items():
        first = size + 2 * (np.cumsum(f >= 0) - 1)    # node j > 0 of the part lies at size - 1 + j
        child = np.where(f >= 0, first, -1)
        feature[0][i], border[0][i], left[0][i], value[0][i] = f[0], b[0], child[0], share[0]
        for column, x in ((feature, f), (border, b), (left, child), (value, share)):
            column.append(x[1:])
        size += len(f) - 1
    feature, border, left, value = (np.concatenate(x) for x in (feature, border, left, value))
    # bin 0 (missing) goes left of every border
    table = np.full((max(len(borders), 1), max((len(b) for b in borders), default=0) + 1), -np.inf)
    for j, b in enumerate(borders):
        table[j, 1:len(b) + 1] = b
    return feature, left, np.where(feature >= 0, table[np.maximum(feature, 0), np.where(feature >= 0, border, 0)], value)


# ---------------------------------------------------------------------------
# the fitted model
# ---------------------------------------------------------------------------

class ForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, MLWritable, MLReadable):
    """Scores a vector column: ``probability`` (of both classes, the mean of the trees' shares) and ``prediction`` (1 above 0.5).
    Saved as a table with one row for each tree."""

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", probabilityCol="probability"):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.trees: list[tuple[bytes, bytes, bytes]] = []
        self.importances: list[float] = []
        self.max_depth = 0

    @classmethod
    def of(cls, trees, importances, p: ForestParams, features_col: str) -> "ForestModel":
        m = cls(featuresCol=features_col)
        m.trees = [tuple(zlib.compress(x.astype(d).tobytes(), 1) for x, d in zip(t, _KINDS)) for t in trees]
        m.importances, m.max_depth = [float(v) for v in importances], p.max_depth
        return m

    @property
    def featureImportances(self) -> np.ndarray:
        """Each feature's Gini gain as a share of its tree's, averaged over the trees."""
        return np.asarray(self.importances)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        forest = _Forest(self.trees, self.max_depth)

        @F.arrow_udf("double")
        def share(x: pa.Array) -> pa.Array:
            flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 1))
            return pa.array(forest.shares(flat))

        p = F.col("_share")
        out = df.withColumn("_share", share(vector_to_array(F.col(self.getFeaturesCol()))))
        return (out.withColumn(self.getProbabilityCol(), array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn(self.getPredictionCol(), F.when(p > 0.5, F.lit(1.0)).otherwise(F.lit(0.0))).drop("_share"))


_KINDS = ("<i2", "<i4", "<f8")


class _Writer(MLWriter):
    def __init__(self, instance: ForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"importances": m.importances, "max_depth": m.max_depth})
        rows = [(i, *map(bytearray, t)) for i, t in enumerate(m.trees)]
        self.sparkSession.createDataFrame(rows, "tree int, feature binary, left binary, x binary").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = self.cls()
        m._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(m, meta)
        m.importances, m.max_depth = meta["importances"], meta["max_depth"]
        # one row for each tree
        m.trees = [tuple(map(bytes, r[1:])) for r in sorted(self.sparkSession.read.parquet(f"{path}/trees").collect())]
        return m


class _Forest:
    """The trees of a task; unpacked once in a worker process."""
    last: tuple[str, list] | None = None

    def __init__(self, trees: list, depth: int):
        self.packed, self.depth, self.key = trees, depth, uuid.uuid4().hex

    def unpacked(self) -> list:
        if _Forest.last is None or _Forest.last[0] != self.key:
            _Forest.last = (self.key, [tuple(np.frombuffer(zlib.decompress(x), d) for x, d in zip(t, _KINDS)) for t in self.packed])
        return _Forest.last[1]

    def shares(self, x: np.ndarray) -> np.ndarray:
        """The mean share of class 1; one tree at a time, so that it stays in the cache."""
        flat, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        out = np.zeros(len(x))
        trees = self.unpacked() if len(x) else []
        for feature, left, value in trees:
            leaf = feature < 0
            f, border = np.where(leaf, 0, feature), np.where(leaf, np.inf, value)
            to = np.where(leaf, np.arange(len(leaf)), left)    # a leaf stays where it is
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = to[at] + (flat[first + f[at]] > border[at])
            out += value[at]
        return out / max(len(trees), 1)
