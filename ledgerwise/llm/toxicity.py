"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs. Each word gives one word input and one input for each n-gram length:
the log odds of toxic labels for the word, and the largest among its character
n-grams (with the spaces around it). They come from document counts in hashed
tables, so unseen forms of a word still carry their stem's evidence. One more
input is the word's length.

Network. A GRU runs over a window's words in either direction; attention
(softmax of ``tanh(h A) . v``) pools both states; a logistic unit gives the
window's score. All overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, are
scored and the largest is the document's score.

Training, in the driver, on a bounded sample: at most ``FIT_DOCS`` labelled
documents of each class (those of smallest id hash; of several rows of an id one),
at most ``FIT_CHARS`` characters of each, drawn over the whole text in pieces. Two thirds fill the tables, one third trains the network
(Adam, backpropagation through time), so it sees the tables as new documents do.
The gradient of a document runs through its best window. As the limit per class
binds on large inputs, the sample's class ratio is not that of the labels; the
classes are counted over all labelled rows, and the output bias and the prior are
shifted to their ratio (``ratio_shift``), so a score means the same at any size.

Scoring is one pass over the texts in Arrow batches; the model, four tables of
``BUCKETS`` bytes and some hundred weights, is broadcast.

Results in odd cases: a null, empty or white-space text gets the labels' prior
(0.01 to 0.49) as its score, as does every text if a class has no labelled
document; repeated rows are scored each; a null doc_id stays null and counts as
not held out; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Hasher, Words, blocks

FIT_DOCS, FIT_CHARS, FIT_PIECE = 2_000, 200_000, 2_000
WINDOW, STRIDE = 64, 32
GRAMS = (4, 5, 6)
BUCKETS = 1 << 20
ODDS_STEP = 1 / 16  # log odds are kept in a byte, from -8 to 8
SMOOTH = 10.0  # documents of either class that each slot starts with, in the classes' ratio
HIDDEN, ATTENTION = 8, 4
BATCH = 2_048
BLOCK_BYTES = 1 << 20
EPOCHS = 8
N_INPUTS = len(GRAMS) + 2


class Inputs:
    """Words of a block with their hashed word and n-gram slots."""

    _hasher: Hasher | None = None

    def __init__(self, column: pa.Array):
        if Inputs._hasher is None:
            Inputs._hasher = Hasher(6)
        h = Inputs._hasher
        w = self.words = Words(column)
        lowered = w.lowered()
        self.word_slot = (h.words(w, lowered) & np.uint64(BUCKETS - 1)).astype(np.int64)
        text, self.starts, self.ends = w.joined(lowered)
        # a space before each text and behind it
        first = w.first[:-1][w.counts > 0]
        shift = np.zeros(len(self.starts), np.int64)
        shift[first] = 1
        shift = np.cumsum(shift)
        buf = np.frombuffer(text, np.uint8)
        padded = np.full(len(buf) + len(first) + 1, 0x20, np.uint8)
        body = np.ones(len(padded), dtype=bool)
        self.starts, self.ends = self.starts + shift, self.ends + shift
        body[self.starts[first] - 1] = False
        body[-1] = False
        padded[body] = buf
        self.code = h.table[padded]

    def gram_slots(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slots of all n-grams that lie in a word and its two spaces, the
        index of the first one of each word, their number)."""
        code = self.code
        total = max(len(code) - n + 1, 0)
        mixed = np.zeros(total, np.uint64)
        for i in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + code[i:i + total]
        slots = (mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
        count = np.maximum(self.ends - self.starts + 3 - n, 0)
        first = self.starts - 1
        return slots, first, count

    def inputs(self, word_odds: np.ndarray, gram_odds: list[np.ndarray]) -> np.ndarray:
        """(words, N_INPUTS) in float32."""
        out = np.zeros((len(self.starts), N_INPUTS), np.float32)
        if not len(out):
            return out
        out[:, 0] = word_odds[self.word_slot] * np.float32(ODDS_STEP)
        for j, (n, odds) in enumerate(zip(GRAMS, gram_odds)):
            slots, first, count = self.gram_slots(n)
            have = count > 0
            if have.any():
                # maxima of the ranges first .. first+count-1: even entries of paired cuts
                cuts = np.column_stack([first[have], first[have] + count[have]]).reshape(-1)
                top = np.maximum.reduceat(np.append(odds[slots], np.int8(-128)), cuts)[::2]
                out[have, j + 1] = top * np.float32(ODDS_STEP)
        out[:, -1] = np.minimum(self.ends - self.starts, 20) / 10
        return out


def document_counts(slots: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """How many documents hold each slot."""
    pair = np.unique(slots * n_docs + doc)
    return np.bincount(pair // n_docs, minlength=BUCKETS)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds by slot, rounded to ODDS_STEP, as bytes."""
    share = n_toxic / (n_toxic + n_clean)
    odds = np.log((toxic + SMOOTH * share) / n_toxic) - np.log((clean + SMOOTH * (1 - share)) / n_clean)
    return np.clip(np.round(odds / ODDS_STEP), -128, 127).astype(np.int8)


def tables(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log odds of words and of n-grams from document counts per class."""
    counts = np.zeros((1 + len(GRAMS), 2, BUCKETS), np.int64)
    for lo in range(0, len(texts), 200):
        for label in (0, 1):
            part = [t for t, y in zip(texts[lo:lo + 200], labels[lo:lo + 200]) if y == label]
            if not part:
                continue
            x = Inputs(pa.array(part, pa.string()))
            doc = np.repeat(np.arange(len(part)), x.words.counts)
            counts[0, label] += document_counts(x.word_slot, doc, len(part))
            for j, n in enumerate(GRAMS):
                slots, first, count = x.gram_slots(n)
                at = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                counts[j + 1, label] += document_counts(slots[at], np.repeat(doc, count), len(part))
    n1 = int(labels.sum())
    odds = [log_odds(c[1], c[0], n1, len(labels) - n1) for c in counts]
    return odds[0], odds[1:]


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word within it, words) of all overlapping windows."""
    n = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    doc = np.repeat(np.arange(len(counts)), n)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    return doc, start, np.minimum(counts[doc] - start, WINDOW)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Parameters by name: for each direction d in f, b: W_d (inputs, 3H), c_d
    (3H), U_d (H, 3H), e_d (H, the candidate's recurrent bias); attention A, a, v;
    output o, p. Gates stand in the order update, reset, candidate."""
    par: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = 0) -> "Network":
        rng = np.random.default_rng(seed)
        par = {}
        for d in "fb":
            par[f"W_{d}"] = rng.normal(0, 0.3, (N_INPUTS, 3 * HIDDEN))
            par[f"c_{d}"] = np.zeros(3 * HIDDEN)
            par[f"U_{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            par[f"e_{d}"] = np.zeros(HIDDEN)
        par |= {"A": rng.normal(0, 0.3, (2 * HIDDEN, ATTENTION)), "a": np.zeros(ATTENTION), "v": rng.normal(0, 0.3, ATTENTION),
                "o": rng.normal(0, 0.3, 2 * HIDDEN), "p": np.zeros(1)}
        return Network(par)

    def typed(self, kind) -> "Network":
        return Network({k: v.astype(kind) for k, v in self.par.items()})

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gates' input parts of every word, for either direction."""
        return tuple(x @ self.par[f"W_{d}"] + self.par[f"c_{d}"] for d in "fb")

    def _run(self, d: str, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States (T, B, H) of one direction; ``gates`` by word, ``at`` (T, B)."""
        U, e, H = self.par[f"U_{d}"], self.par[f"e_{d}"], HIDDEN
        steps, b = at.shape
        out = np.empty((steps, b, H), gates.dtype)
        h = np.zeros((b, H), gates.dtype)
        full = mask.all(axis=1)
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            g = gates[at[t]]
            u = h @ U
            zr = _sigmoid(g[:, :2 * H] + u[:, :2 * H])
            z, r = zr[:, :H], zr[:, H:]
            s = u[:, 2 * H:] + e
            n = np.tanh(g[:, 2 * H:] + r * s)
            new = n + z * (h - n)
            if not full[t]:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, s, n))
            h = out[t] = new
        return out

    def _pool(self, states: np.ndarray, mask: np.ndarray):
        p = self.par
        u = np.tanh(states @ p["A"] + p["a"])
        score = np.where(mask, u @ p["v"], states.dtype.type(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        context = np.einsum("tb,tbh->bh", weight, states)
        return context @ p["o"] + p["p"][0], u, weight, context

    def logits(self, gates: tuple, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """One logit per window of words first .. first+length-1."""
        out = np.empty(len(first), gates[0].dtype)
        for lo in range(0, len(first), BATCH):
            at, mask = _grid(first[lo:lo + BATCH], length[lo:lo + BATCH])
            states = np.concatenate([self._run(d, g, at, mask, None) for d, g in zip("fb", gates)], axis=2)
            out[lo:lo + BATCH] = self._pool(states, mask)[0]
        return out

    def gradients(self, x: np.ndarray, first: np.ndarray, length: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Weighted log loss of windows and its gradients (backpropagation through time)."""
        p, H = self.par, HIDDEN
        at, mask = _grid(first, length)
        kept = {"f": [], "b": []}
        states = np.concatenate([self._run(d, g, at, mask, kept[d]) for d, g in zip("fb", self.project(x))], axis=2)
        logit, u, attention, context = self._pool(states, mask)
        prob = _sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum())
        d_logit = weight * (prob - y)
        g = {"o": context.T @ d_logit, "p": np.array([d_logit.sum()])}
        d_context = d_logit[:, None] * p["o"]
        d_states = attention[:, :, None] * d_context
        d_att = np.einsum("bh,tbh->tb", d_context, states)
        d_score = attention * (d_att - (attention * d_att).sum(axis=0)) * mask
        g["v"] = np.einsum("tb,tba->a", d_score, u)
        d_u = d_score[:, :, None] * p["v"] * (1 - u * u)
        g["A"] = np.einsum("tbh,tba->ha", states, d_u)
        g["a"] = d_u.sum(axis=(0, 1))
        d_states = d_states + d_u @ p["A"].T
        for k, d in enumerate("fb"):
            U = p[f"U_{d}"]
            dW, dc = np.zeros_like(p[f"W_{d}"]), np.zeros_like(p[f"c_{d}"])
            dU, de = np.zeros_like(U), np.zeros_like(p[f"e_{d}"])
            dh = np.zeros((len(first), H))
            for t, h, z, r, s, n in reversed(kept[d]):
                dh = dh + d_states[t, :, k * H:(k + 1) * H]
                on = mask[t][:, None]
                step = np.where(on, dh, 0)
                dn = step * (1 - z) * (1 - n * n)
                dz = step * (h - n) * z * (1 - z)
                dr = dn * s * r * (1 - r)
                ds = dn * r
                gate = np.concatenate([dz, dr, dn], axis=1)
                recurrent = np.concatenate([dz, dr, ds], axis=1)
                dW += x[at[t]].T @ gate
                dc += gate.sum(axis=0)
                dU += h.T @ recurrent
                de += ds.sum(axis=0)
                dh = np.where(on, step * z + recurrent @ U.T, dh)
            g |= {f"W_{d}": dW, f"c_{d}": dc, f"U_{d}": dU, f"e_{d}": de}
        return loss, g


def _grid(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(T, B) word indices, and which of them belong to the window."""
    step = np.arange(int(length.max(initial=1)))[:, None]
    mask = step < length
    return np.where(mask, first + step, first), mask


@dataclass
class Model:
    prior: float
    word_odds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int8))
    gram_odds: list = field(default_factory=list)
    network: Network | None = None

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(score, windows) of each text."""
        x = Inputs(column)
        counts = x.words.counts
        out = np.full(len(counts), self.prior)
        doc, start, length = windows(counts)
        if self.network is not None and len(doc):
            gates = self.network.project(x.inputs(self.word_odds, self.gram_odds))
            logit = self.network.logits(gates, x.words.first[doc] + start, length)
            best = np.full(len(counts), -np.inf)
            np.maximum.at(best, doc, logit)
            full = counts > 0
            out[full] = _sigmoid(best[full])
        return np.clip(out, 0.0, 1.0), np.bincount(doc, minlength=len(counts))


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 0, shift: float = 0.0) -> Model:
    """Tables and network from (text, label) in the order of their id hash;
    ``shift`` is added to the log odds of toxic that the sample has."""
    sample = [(t, y) for t, y in sample if t and t.split()]
    y = np.array([label for _, label in sample], dtype=int)
    odds = np.exp(shift) * y.sum()
    prior = float(np.clip(odds / (odds + (y == 0).sum()) if len(y) else 0.0, 0.01, 0.49))
    if len(set(y.tolist())) < 2:
        return Model(prior)
    rng = np.random.default_rng(seed)
    # the same share of both classes goes to the tables
    rank = np.empty(len(y), dtype=int)
    for label in (0, 1):
        rank[y == label] = np.arange((y == label).sum())
    table = rank % 3 < 2
    texts = [t for t, _ in sample]
    word_odds, gram_odds = tables([t for t, k in zip(texts, table) if k], y[table])
    rest = ~table if len(set(y[~table].tolist())) == 2 else np.ones(len(y), dtype=bool)
    x = Inputs(pa.array([t for t, k in zip(texts, rest) if k], pa.string()))
    y = y[rest].astype(float)
    values = x.inputs(word_odds, gram_odds).astype(np.float64)
    doc, start, length = windows(x.words.counts)
    first = x.words.first[doc] + start
    cut = np.searchsorted(doc, np.arange(len(y) + 1))
    net, step = Network.new(seed), 0
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.par.items()}
    for epoch in range(epochs):
        fast = net.typed(np.float32)
        logit = fast.logits(fast.project(values.astype(np.float32)), first, length)
        order = np.lexsort((-logit, doc))
        best = order[cut[:-1]]  # each document's best window under the present network
        mix = rng.permutation(len(y))
        size = max(32, len(y) // 40)
        for lo in range(0, len(y), size):
            part = mix[lo:lo + size]
            _, grads = net.gradients(values, first[best[part]], length[best[part]], y[part], np.full(len(part), 1 / len(part)))
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.par[k] -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    net.par["p"] += shift
    return Model(prior, word_odds, gram_odds, net.typed(np.float32))


def _usable(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def ratio_shift(labels: DataFrame, fit_docs: int = FIT_DOCS) -> float:
    """Log odds of toxic among all usable labels, less those among the ids that
    ``fit_sample`` takes: zero if ``fit_docs`` binds on neither class."""
    n = {r.toxic: r.n for r in _usable(labels).groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    toxic, clean = (max(n.get(label, 0) / fit_docs, 1.0) for label in (1, 0))
    return float(np.log(toxic / clean))


def drawn_text(text: F.Column, chars: int, piece: int = FIT_PIECE) -> F.Column:
    """The text, or of a longer one than ``chars`` pieces of it, drawn by hash over its whole length
    and in their order, without the words that their ends cut."""
    n = F.ceil(F.length(text) / F.lit(piece)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.xxhash64(F.xxhash64(text), i).alias("h"), i.alias("i"),
        F.regexp_replace(F.substring(text, i * piece + 1, F.lit(piece)), r"^\S*\s|\s\S*$", " ").alias("t")))
    some = F.slice(F.array_sort(cut), 1, max(1, chars // piece))
    joined = F.array_join(F.transform(F.array_sort(F.transform(some, lambda x: F.struct(x["i"], x["t"]))), lambda x: x["t"]), " ")
    return F.when(F.length(text) > chars, joined).otherwise(text)


def fit_sample(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> list[tuple[str, int]]:
    """The bounded sample: labelled rows that are not held out, by id hash."""
    spark = docs.sparkSession
    ids = []
    for label in (0, 1):
        ids += (_usable(labels).filter(F.col("toxic") == label).select("doc_id").distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs).select("doc_id", F.lit(label).alias("toxic")).collect())
    chosen = spark.createDataFrame([(r.doc_id, r.toxic) for r in ids], "doc_id long, toxic int")
    # the id list is bounded by fit_docs, so it may be broadcast; of several rows of one id one is taken
    rows = (docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row"))
            .select("doc_id", drawn_text(F.col("row.text"), fit_chars).alias("text"), "toxic", F.xxhash64("doc_id").alias("h")).collect())
    rows = {(r.doc_id, r.text): r for r in rows if r.text}
    return [(r.text, r.toxic) for r in sorted(rows.values(), key=lambda r: (r.h, r.doc_id, r.text))]


def held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id as text modulo 5 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    return fit(fit_sample(docs, labels, fit_docs), shift=ratio_shift(labels, fit_docs))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, n_windows)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # four tables of BUCKETS bytes and the network

    def run(batches):
        model = shared.value
        for b in blocks(batches, "text", BLOCK_BYTES):
            s, n = model.score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array(n.astype(np.int64))],
                                             ["doc_id", "score", "n_windows"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = src.mapInArrow(run, "doc_id long, score double, n_windows long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows")
