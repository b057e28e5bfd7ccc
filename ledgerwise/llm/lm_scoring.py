"""Language-model scores of whole texts: a log-bilinear model by noise-contrastive estimation.

Tokens are the words with A-Z lower-cased, then one end token. The model factors a
token into its class and itself within the class:

* Classes: the end, each of the ``frequent`` most frequent tokens, and ``suffixes``
  classes of the other tokens by a hash of their last bytes.
* P(class | the two classes before) is log-bilinear: the context's vectors, each
  times a matrix of its position, add up to a predicted vector; its product with
  a class's vector plus the class's bias is the class's score. It is trained in numpy
  with noise-contrastive estimation (noise: the class frequencies). Scores are
  normalised over all classes, by matrix products over a block's distinct contexts.
* P(token | class) is by its training count less an absolute discount; what the discount
  frees is the probability of a token never seen, one such outcome in each class.

Together these are a distribution over the known tokens and the classes' unseen
outcomes. All counts cover every training row: the token counts, and the counts of
class triples, which each task sums before the shuffle. The triples are bounded by the
number of classes cubed (``MAX_CLASSES``), so they can go to the driver, where the
training draws its batches from them: its length does not depend on the corpus.

Texts are tokenised once, into blocks written as a table: a dictionary of the
block's distinct tokens, most frequent first, and the texts as numbers into it.
Dictionaries are joined to the counts and classes of tokens, one row a distinct token
and block, and come back grouped by block to meet the texts.

Results in odd cases: a null or empty text is its end token; a null id is hashed as an
empty string (and so held out); repeated rows are documents of their own; with no training
rows every token is unseen and all classes score alike; an empty table gives an empty
result; tokens of over ``LONG_TOKEN`` bytes are told apart by 128 bits of SHA-256; bytes
that are no UTF-8 are compared as they are; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Words, blocks
from ledgerwise.session import materialize, stage_path

BLOCK_BYTES = 4 << 20
FREQUENT, SUFFIXES = 63, 64
MAX_CLASSES = 256       # the triples of a task and of the driver are counted in memory
LONG_TOKEN = 64
SUFFIX_BYTES = 3
SIZE, STEPS, BATCH, NOISE, RATE, SEED = 24, 2_000, 512, 48, 0.02, 12
SMOOTHING = 0.1         # of the base score
END = b""               # no word is empty


# ---------------------------------------------------------------------------
# the model
# ---------------------------------------------------------------------------

@dataclass
class LogBilinear:
    """Scores of ``classes`` targets after two context classes; context ``classes`` is
    the place before a text. ``par``: vectors R of contexts, matrices C1 and C2 of their
    positions (C1: the nearer), vectors Q and biases b of targets."""
    classes: int
    par: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def new(frequency: np.ndarray, size: int = SIZE, seed: int = SEED) -> "LogBilinear":
        rng, k = np.random.default_rng(seed), len(frequency)
        return LogBilinear(k, {"R": rng.normal(0, 0.1, (k + 1, size)), "C1": np.eye(size), "C2": np.eye(size) * 0.5,
                               "Q": rng.normal(0, 0.1, (k, size)), "b": np.log(frequency)})

    def predicted(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        return self.par["R"][near] @ self.par["C1"] + self.par["R"][far] @ self.par["C2"]

    def log_probabilities(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Natural logarithms, a row for each context, normalised over all classes."""
        s = self.predicted(far, near) @ self.par["Q"].T + self.par["b"]
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))

    def gradients(self, far, near, target, noise, noise_log) -> tuple[float, dict[str, np.ndarray]]:
        """Mean noise-contrastive loss of a batch and its gradients. ``noise`` is drawn once
        for the batch; ``noise_log``: the log of its number times each class's noise share."""
        p, n = self.par, len(target)
        r = self.predicted(far, near)
        true = (r * p["Q"][target]).sum(axis=1) + p["b"][target] - noise_log[target]
        false = r @ p["Q"][noise].T + p["b"][noise] - noise_log[noise]
        loss = (np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum()) / n
        g_true, g_false = (_sigmoid(true) - 1) / n, _sigmoid(false) / n
        g_r = g_true[:, None] * p["Q"][target] + g_false @ p["Q"][noise]
        grads = {"Q": _scatter(target, g_true[:, None] * r, self.classes) + _scatter(noise, g_false.T @ r, self.classes),
                 "b": np.bincount(target, g_true, self.classes) + np.bincount(noise, g_false.sum(0), self.classes),
                 "C1": p["R"][near].T @ g_r, "C2": p["R"][far].T @ g_r,
                 "R": _scatter(near, g_r @ p["C1"].T, self.classes + 1) + _scatter(far, g_r @ p["C2"].T, self.classes + 1)}
        return loss, grads

    def fit(self, triples: np.ndarray, counts: np.ndarray, steps: int = STEPS, seed: int = SEED) -> "LogBilinear":
        """Batches are drawn from the counted triples (codes of ``triple_code``), as often
        as they occur; steps by Adam with a falling rate."""
        if not len(triples):
            return self
        rng, total = np.random.default_rng(seed), np.cumsum(counts, dtype=np.float64)
        of_target = np.bincount(triples % self.classes, counts, self.classes) + 1.0
        share = of_target / of_target.sum()
        cumulated, noise_log = np.cumsum(share), np.log(NOISE * share)
        first, second = ({k: np.zeros_like(v) for k, v in self.par.items()} for _ in range(2))
        for t in range(1, steps + 1):
            drawn = triples[np.searchsorted(total, rng.random(BATCH) * total[-1], side="right")]
            context, target = np.divmod(drawn, self.classes)
            far, near = np.divmod(context, self.classes + 1)
            noise = np.minimum(np.searchsorted(cumulated, rng.random(NOISE), side="right"), self.classes - 1)
            _, grads = self.gradients(far, near, target, noise, noise_log)
            rate = RATE * (1 - t / (steps + 1))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                self.par[k] -= rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row."""
    size = values.shape[1]
    at = (rows[:, None] * size + np.arange(size)).ravel()
    return np.bincount(at, values.ravel(), n * size).reshape(n, size)


def triple_code(classes: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Codes of (class two before, class before, class) for texts laid end to end;
    ``first``: where each text begins (each has a token)."""
    near = np.concatenate(([k], classes[:-1]))
    near[first] = k
    far = np.concatenate(([k], near[:-1]))
    far[first] = k
    return (far * (k + 1) + near) * k + classes


# ---------------------------------------------------------------------------
# blocks of coded texts
# ---------------------------------------------------------------------------

BLOCK_SCHEMA = "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, codes binary, tokens array<binary>, counts array<long>"


def _tokens(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(numbers of the tokens, distinct tokens, tokens of each text) of a block; END is number 0."""
    w = Words(column)
    length = w.ends - w.starts
    inside = np.zeros(len(w.buf) + 1, dtype=np.int8)
    np.add.at(inside, w.starts, 1)
    np.subtract.at(inside, w.ends, 1)
    letters = w.lowered()[np.cumsum(inside[:-1]).astype(bool)]
    offsets = np.concatenate(([0], np.cumsum(length)))
    words = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))])
    coded = words.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    falling = np.argsort(-np.bincount(numbers, minlength=len(coded.dictionary)), kind="stable")
    place = np.empty(len(falling), dtype=np.int64)
    place[falling] = np.arange(1, len(falling) + 1)
    numbers = place[numbers]
    size = w.counts + 1
    out = np.zeros(len(numbers) + len(size), dtype=np.int64)
    at = np.ones(len(out), dtype=bool)
    at[np.cumsum(size) - 1] = False  # each text's end
    out[at] = numbers
    distinct = [END] + [t if len(t) <= LONG_TOKEN else b" " + sha256(t).digest()[:16] for t in coded.dictionary.take(pa.array(falling)).to_pylist()]
    return out, pa.array(distinct, pa.binary()), size


def _packed(numbers: np.ndarray) -> bytes:
    """Four planes of bytes, compressed; most of the higher ones are zero."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], decompressed_size=4 * int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def coded_blocks(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a block of texts (see ``BLOCK_SCHEMA``), written and read again.
    ``counts``: how often each distinct token occurs in the block's training texts."""
    def run(batches):
        n, part = 0, TaskContext.get().partitionId()
        for b in blocks(batches, "text", BLOCK_BYTES):
            numbers, tokens, size = _tokens(b.column("text"))
            held = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(numbers[np.repeat(~held, size)], minlength=len(tokens))
            row = [part << 32 | n, b.column("doc_id").to_pylist(), held, size.astype(np.int32), _packed(numbers), tokens, counts]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) if not isinstance(x, pa.Array) else pa.ListArray.from_arrays([0, len(x)], x)
                                              for x, k in zip(row, kinds)], [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])
            n += 1

    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held"))
    path = stage_path(spark, "lm-blocks")
    src.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


# ---------------------------------------------------------------------------
# classes and counts
# ---------------------------------------------------------------------------

@dataclass
class Classes:
    """Token classes: 0 the end, then the frequent tokens, then suffix classes."""
    frequent: list[bytes]
    suffixes: int

    @property
    def n(self) -> int:
        return 1 + len(self.frequent) + self.suffixes

    def of(self, tokens: pa.Array) -> np.ndarray:
        tokens = tokens.cast(pa.large_binary())
        off = np.frombuffer(tokens.buffers()[1], dtype=np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        data = np.frombuffer(tokens.buffers()[2], np.uint8) if tokens.buffers()[2] is not None else np.zeros(0, np.uint8)
        data, ends, length = np.concatenate((np.zeros(SUFFIX_BYTES, np.uint8), data)), off[1:] + SUFFIX_BYTES, np.diff(off)
        code = np.zeros(len(tokens), dtype=np.uint64)
        for i in range(1, SUFFIX_BYTES + 1):
            code = code * np.uint64(257) + np.where(length >= i, data[ends - i].astype(np.uint64) + np.uint64(1), np.uint64(0))
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        out = 1 + len(self.frequent) + (code % np.uint64(self.suffixes)).astype(np.int64)
        known = pc.index_in(tokens, value_set=pa.array([END, *self.frequent], pa.large_binary()))
        known = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(known >= 0, known, out)


def with_classes(counts: DataFrame, classes: Classes) -> DataFrame:
    """(token, c, class) of ``token_counts``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("token"), b.column("c"), pa.array(classes.of(b.column("token")))], ["token", "c", "class"])

    return counts.mapInArrow(run, "token binary, c long, class long")


def token_counts(coded: DataFrame) -> DataFrame:
    """(token, c): training counts of all tokens that occur, also of those only held out."""
    each = coded.select(F.explode(F.arrays_zip("tokens", "counts")).alias("x"))
    return each.groupBy(F.col("x.tokens").alias("token")).agg(F.sum("x.counts").alias("c"))


def frequent_tokens(counts: DataFrame, n: int) -> list[bytes]:
    top = counts.filter((F.length("token") > 0) & (F.col("c") > 0)).orderBy(F.desc("c"), "token").limit(n)
    return [bytes(r["token"]) for r in top.collect()]


def class_sums(counts: DataFrame, classes: Classes) -> dict[str, np.ndarray]:
    """Of each class its training tokens (n), distinct tokens (types), and those seen once and twice."""
    names = ["n", "types", "once", "twice"]

    def run(batches):
        total = np.zeros((4, classes.n), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                k, c = classes.of(b.column("token")), b.column("c").to_numpy()
                for i, x in enumerate((c, c > 0, c == 1, c == 2)):
                    total[i] += np.bincount(k, x, classes.n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes.n)), *map(pa.array, total)], ["class", *names])

    sums = counts.mapInArrow(run, "class long, " + ", ".join(f"{x} long" for x in names)).groupBy("class").agg(*[F.sum(x).alias(x) for x in names])
    out = {x: np.zeros(classes.n, dtype=np.int64) for x in names}
    for r in sums.collect():  # a row for each class
        for x in names:
            out[x][r["class"]] = r[x]
    return out


def class_triples(coded: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the class triples of all training texts."""
    k = classes.n

    def run(batches):
        total = np.zeros((k + 1) * (k + 1) * k, dtype=np.int64)
        for row in _rows(batches):
            held, size = row["held"].to_numpy(zero_copy_only=False).astype(bool), row["sizes"].to_numpy()
            if held.all():
                continue
            own = classes.of(row["tokens"])[row["numbers"][np.repeat(~held, size)]]
            size = size[~held]
            total += np.bincount(triple_code(own, np.cumsum(size) - size, k), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    found = coded.select("held", "sizes", "codes", "tokens").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # bounded by the number of classes cubed; rows as objects would take a multiple
    codes, counts = table.column("code").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(codes)
    return codes[order], counts[order]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a block table, lists as arrays and the texts' numbers unpacked."""
    for b in batches:
        for i in range(b.num_rows):
            row = {}
            for name, column in zip(b.schema.names, b.columns):
                row[name] = column[i].values if pa.types.is_list(column.type) else column[i].as_py()
            row["numbers"] = _unpacked(row.pop("codes"))
            yield row


# ---------------------------------------------------------------------------
# training and scoring
# ---------------------------------------------------------------------------

@dataclass
class Model:
    classes: Classes
    network: LogBilinear
    sums: dict[str, np.ndarray]

    @property
    def tokens(self) -> int:
        return int(self.sums["n"].sum())

    @property
    def vocabulary(self) -> int:
        return int(self.sums["types"].sum())

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTHING) / (self.tokens + SMOOTHING * (self.vocabulary + 1)))

    def within(self, c: np.ndarray, k: np.ndarray) -> np.ndarray:
        """log10 P(token | class) of tokens with training count ``c`` in classes ``k``."""
        open_from = 1 + len(self.classes.frequent)
        once, twice = (int(self.sums[x][open_from:].sum()) for x in ("once", "twice"))
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        n = np.maximum(self.sums["n"], 1)
        unseen = np.where(self.sums["n"] > 0, discount * self.sums["types"] / n, 1.0)
        p = np.where(c > 0, (c - discount) / n[k], unseen[k])
        return np.log10(np.where(k < open_from, 1.0, p))  # the others are alone in their classes

    def token_scores(self, numbers: np.ndarray, size: np.ndarray, k: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 probability of each token of a block's texts; ``k`` and ``c`` are the class
        and training count of each token of its dictionary."""
        own = k[numbers]
        code = triple_code(own, np.cumsum(size) - size, self.classes.n)
        contexts, at = np.unique(code // self.classes.n, return_inverse=True)
        far, near = np.divmod(contexts, self.classes.n + 1)
        table = self.network.log_probabilities(far, near) / np.log(10)
        return table[at, own] + self.within(c, k)[numbers]


def train(coded: DataFrame, counts: DataFrame, frequent: int = FREQUENT, suffixes: int = SUFFIXES, steps: int = STEPS) -> Model:
    if 1 + frequent + suffixes > MAX_CLASSES:
        raise ValueError(f"at most {MAX_CLASSES} classes")
    classes = Classes(frequent_tokens(counts, frequent), suffixes)
    sums = class_sums(counts, classes)
    network = LogBilinear.new((sums["n"] + 1.0) / (sums["n"].sum() + classes.n))
    return Model(classes, network.fit(*class_triples(coded, classes), steps=steps), sums)


def held_out(doc_id, folds: int = 10):
    """Whether crc32(doc_id as text) is divisible by ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def score(docs: DataFrame, folds: int = 10, frequent: int = FREQUENT, suffixes: int = SUFFIXES, steps: int = STEPS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    coded = coded_blocks(docs, held_out(F.col(id_col).cast("long"), folds), id_col, text_col)
    counts = materialize(token_counts(coded), "lm-counts")
    model = train(coded, counts, frequent, suffixes, steps)
    places = coded.select("block", F.posexplode("tokens").alias("pos", "token"))
    # a block has a bounded number of distinct tokens, or one text's
    found = (places.join(with_classes(counts, model.classes), "token").groupBy("block")
             .agg(F.collect_list(F.struct((F.col("pos") * MAX_CLASSES + F.col("class")).alias("place"), "c")).alias("found")))

    def run(batches):
        for row in _rows(batches):
            at, own = np.divmod(row["found"].field("place").to_numpy(), MAX_CLASSES)
            k, c = np.zeros((2, len(at)), dtype=np.int64)
            k[at], c[at] = own, row["found"].field("c").to_numpy()
            numbers, size = row["numbers"], row["sizes"].to_numpy()
            first = np.cumsum(size) - size
            known, base, full = (np.add.reduceat(x, first) for x in (
                (c > 0).astype(np.int64)[numbers], model.base(c)[numbers], model.token_scores(numbers, size, k, c)))
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"], row["held"], pa.array(size.astype(np.int64)), pa.array(known), pa.array(np.full(len(size), model.tokens)),
                 pa.array(base), pa.array(full)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = coded.select("block", "doc_ids", "held", "sizes", "codes").join(found, "block")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
