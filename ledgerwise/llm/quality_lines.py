"""Quality rules: line sequence labelling by a linear-chain conditional random field.

Every line with a word is described by binary features (symbols, bars, shouting,
repetition, length, ...). The model has one weight per feature and state
(content, boilerplate) and one per pair of neighbouring states; Viterbi
decoding over the whole text marks each line, and a document is kept if the
lines marked as content hold at least ``min_share`` of its words. Before that a
base rule rejects texts that are too short or mostly repeat themselves.

The weights are fitted with forward-backward gradients in numpy on a bounded
sample: at most ``FIT_DOCS`` labelled documents of each class (those of smallest
id hash; of several rows of an id one), and of each at most ``FIT_LINES`` lines in a
row, whose place in the whole text is drawn by hash. A training line is boilerplate if its
document's quality is 0 and it shows one of the ``SIGNS``, else content.
Without labels of both classes the fixed ``DEFAULT`` weights are used.

Results in odd cases: a null or empty text has no words, so its base rule
fails; repeated rows are judged each; a null doc_id stays null; an empty table
gives an empty result; further columns stay in ``keep_good`` and are ignored
in ``quality_rules``.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Hasher, Words, blocks, scramble

FIT_DOCS = 1_000
FIT_LINES = 64
MIN_WORDS = 10
WINDOW = 5

FEATURES = ["bias", "symbols", "bars", "exclaims", "shouts", "repeats_line", "few_words", "many_words",
            "repeats_words", "digits", "plain"]
SIGNS = ["symbols", "bars", "exclaims", "shouts", "repeats_line", "repeats_words"]
CONTENT, BOILERPLATE = 0, 1


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars.encode())] = True
    return table


_SYMBOL = _class("#*$%&|<>")
_BAR = _class("|")
_EXCLAIM = _class("!")
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _class("0123456789")
_START = np.array([(b & 0xC0) != 0x80 for b in range(256)])  # first byte of a code point


@dataclass
class Crf:
    """emission[state, feature] and transition[before, after]."""
    emission: np.ndarray
    transition: np.ndarray

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best state of each line of one text (Viterbi); ties go to content."""
        e = (x @ self.emission.T).tolist()
        (t00, t01), (t10, t11) = self.transition.tolist()
        if not e:
            return np.zeros(0, dtype=np.int8)
        a, b = e[0]
        back = []
        for p, q in e[1:]:
            from0, from1 = a + t00 < b + t10, a + t01 < b + t11
            back.append((from0, from1))
            a, b = p + (b + t10 if from0 else a + t00), q + (b + t11 if from1 else a + t01)
        state = int(b > a)
        path = [state]
        for step in reversed(back):
            state = int(step[state])
            path.append(state)
        return np.array(path[::-1], dtype=np.int8)


#: bias, symbols, bars, exclaims, shouts, repeats_line, few_words, many_words, repeats_words, digits, plain
DEFAULT = Crf(np.array([[1.0, -2.0, -2.0, -1.5, -1.5, -1.0, -0.3, 0.5, -1.0, -0.5, 1.0],
                        [-1.0, 2.0, 2.0, 1.5, 1.5, 1.0, 0.3, -0.5, 1.0, 0.5, -1.0]]),
              np.array([[0.4, -0.4], [-0.4, 0.4]]))


class Lines:
    """Counts and line features of a block of texts."""

    _hasher: Hasher | None = None

    def __init__(self, column: pa.Array):
        if Lines._hasher is None:
            Lines._hasher = Hasher(3)
        w = self.words = Words(column)
        buf, off = w.buf, w.offsets
        n = len(off) - 1
        newline = np.flatnonzero(buf == 10)
        per_doc = np.diff(np.searchsorted(newline, off)) + 1
        self.line_first = np.concatenate(([0], np.cumsum(per_doc)))
        total = int(self.line_first[-1])
        opener = np.zeros(total, dtype=bool)
        opener[self.line_first[:-1]] = True
        closer = np.zeros(total, dtype=bool)
        closer[self.line_first[1:] - 1] = True
        self.starts, self.ends = np.empty(total, np.int64), np.empty(total, np.int64)
        self.starts[opener], self.starts[~opener] = off[:-1], newline + 1
        self.ends[closer], self.ends[~closer] = off[1:], newline
        self.doc = np.repeat(np.arange(n), per_doc)
        self.word_lo = np.searchsorted(w.starts, self.starts)
        self.n_words = np.searchsorted(w.starts, self.ends) - self.word_lo

        self.repeated = self._repeated_words()
        self.dup = self._repeated_lines()
        cover = np.concatenate(([0], np.cumsum(self.repeated)))
        self.doc_words = w.counts
        self.n_repeat_words = cover[w.first[1:]] - cover[w.first[:-1]]
        self.line_repeat = cover[self.word_lo + self.n_words] - cover[self.word_lo]
        in_words = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(self._word_bytes() & _START[buf], out=in_words[1:])
        self.word_chars = in_words[off[1:]] - in_words[off[:-1]]
        self.n_symbols = self._sums(_SYMBOL, off[:-1], off[1:])
        self.n_dup_lines = np.bincount(self.doc[self.dup], minlength=n)

    def _word_bytes(self) -> np.ndarray:
        step = np.zeros(len(self.words.buf) + 1, np.int8)
        step[self.words.starts] += 1
        step[self.words.ends] -= 1
        return np.cumsum(step[:-1], dtype=np.int8).astype(bool)

    def _sums(self, table: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.words.buf) + 1, np.int64)
        np.cumsum(table[self.words.buf], out=total[1:])
        return total[hi] - total[lo]

    def _repeated_words(self) -> np.ndarray:
        """Whether each word lies in a window of its text found twice or more."""
        w, h = self.words, Lines._hasher
        counts = np.maximum(w.counts - WINDOW + 1, 0)
        total = int(counts.sum())
        if total == 0:
            return np.zeros(len(w.starts), dtype=bool)
        begin = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(total) - np.repeat(begin[:-1] - w.first[:-1], counts)
        key = h.runs(h.prefix(h.words(w)), at, at + WINDOW)
        key ^= np.repeat(scramble(np.arange(1, len(counts) + 1, dtype=np.uint64)), counts)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(total, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(w.starts) + 1, np.int32)
        step[at[twice]] += 1
        step[at[twice] + WINDOW] -= 1
        return np.cumsum(step[:-1]) > 0

    def _repeated_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        raw = self.words.buf.tobytes()
        out = np.zeros(len(self.starts), dtype=bool)
        seen: set[bytes] = set()
        doc = -1
        for i in np.flatnonzero(self.n_words).tolist():
            if self.doc[i] != doc:
                doc = self.doc[i]
                seen = set()
            line = raw[self.starts[i]:self.ends[i]]
            if line in seen:
                out[i] = True
            else:
                seen.add(line)
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(lines with a word, their binary features)."""
        at = np.flatnonzero(self.n_words)
        lo, hi, n = self.starts[at], self.ends[at], self.n_words[at]
        upper, lower = self._sums(_UPPER, lo, hi), self._sums(_LOWER, lo, hi)
        x = np.stack([
            np.ones(len(at), dtype=bool),
            2 * (self._sums(_SYMBOL, lo, hi) - self._sums(_BAR, lo, hi)) >= n,
            4 * self._sums(_BAR, lo, hi) >= n,
            3 * self._sums(_EXCLAIM, lo, hi) >= n,
            (upper > 1.5 * lower) & (upper >= 3),
            self.dup[at],
            n < 4,
            n >= 20,
            2 * self.line_repeat[at] >= n,
            3 * self._sums(_DIGIT, lo, hi) >= hi - lo,
        ], axis=1)
        plain = ~x[:, [FEATURES.index(f) for f in SIGNS]].any(axis=1)
        return at, np.column_stack([x, plain])


def _judge(column: pa.Array, model: Crf, min_share: float, max_repeat_pct: int) -> tuple[dict, list]:
    """Columns of one block, and each line's state (-1: no word)."""
    t = Lines(column)
    at, x = t.features()
    state = np.full(len(t.starts), -1, dtype=np.int8)
    scores = x.astype(np.float64)
    cut = np.searchsorted(at, t.line_first)
    for d in range(len(t.doc_words)):
        if cut[d + 1] > cut[d]:
            state[at[cut[d]:cut[d + 1]]] = model.decode(scores[cut[d]:cut[d + 1]])
    content = np.bincount(t.doc, weights=np.where(state == CONTENT, t.n_words, 0), minlength=len(t.doc_words)).astype(np.int64)
    failed = (t.doc_words < MIN_WORDS) | (100 * t.n_repeat_words > max_repeat_pct * t.doc_words)
    share = content / np.maximum(t.doc_words, 1)
    return {"n_words": t.doc_words.astype(np.int64), "word_chars": t.word_chars, "n_symbols": t.n_symbols,
            "n_dup_lines": t.n_dup_lines.astype(np.int64), "n_repeat_words": t.n_repeat_words.astype(np.int64),
            "base_failed": failed, "kept": ~failed & (share >= min_share), "content_words": content,
            "content_share": share}, np.split(state, t.line_first[1:-1])


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_words long, content_share double")


def quality_rules(docs: DataFrame, model: Crf = DEFAULT, min_share: float = 0.5, max_repeat_pct: int = 20,
                  line_states: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, verdict, words in content lines. With
    ``line_states`` also each line's state: 0 content, 1 boilerplate, -1 no word."""
    def run(batches):
        for b in blocks(batches, "text"):
            cols, states = _judge(b.column("text"), model, min_share, max_repeat_pct)
            arrays = [b.column("doc_id"), *[pa.array(v) for v in cols.values()]]
            names = ["doc_id", *cols]
            if line_states:
                arrays.append(pa.array([s.tolist() for s in states], pa.list_(pa.int32())))
                names.append("line_states")
            yield pa.RecordBatch.from_arrays(arrays, names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA + (", line_states array<int>" if line_states else ""))


def keep_good(docs: DataFrame, model: Crf = DEFAULT, min_share: float = 0.5, max_repeat_pct: int = 20,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, in one pass without a shuffle."""
    def run(batches):
        for b in blocks(batches, text_col):
            cols, _ = _judge(b.column(text_col), model, min_share, max_repeat_pct)
            yield b.filter(pa.array(cols["kept"]))

    return docs.mapInArrow(run, docs.schema)


def fit_sample(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_lines: int = FIT_LINES) -> list:
    """(quality, lines' feature bits) of the bounded training sample."""
    spark = docs.sparkSession
    ids = []
    for q in (0, 1):
        ids += (labels.filter((F.col("quality") == q) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs).collect())
    chosen = spark.createDataFrame([(r.doc_id, r.quality) for r in ids], "doc_id long, quality int")

    def run(batches):
        for b in blocks(batches, "text"):
            t = Lines(b.column("text"))
            at, x = t.features()
            code = x @ (1 << np.arange(x.shape[1]))
            cut = np.searchsorted(at, t.line_first)
            rows = [_run_of(code[cut[d]:cut[d + 1]], fit_lines).tolist() for d in range(len(t.doc_words))]
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array(rows, pa.list_(pa.int32()))], ["quality", "lines"])

    # the id list is bounded by fit_docs, so it may be broadcast; of several rows of one id one is taken
    src = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")).select("row.text", "quality")
    return sorted((r.quality, list(r.lines)) for r in src.mapInArrow(run, "quality int, lines array<int>").collect() if r.lines)


def _run_of(codes: np.ndarray, longest: int) -> np.ndarray:
    """At most ``longest`` consecutive lines, from a place that a hash of the whole text's lines gives."""
    if len(codes) <= longest:
        return codes
    at = crc32(codes.astype("<i8").tobytes()) % (len(codes) - longest + 1)
    return codes[at:at + longest]


def fit_crf(sample: list, steps: int = 120, rate: float = 0.2, l2: float = 1e-3) -> Crf:
    """Maximum likelihood by gradient ascent (Adam) with batched forward-backward."""
    if {q for q, _ in sample} != {0, 1}:
        return DEFAULT
    k = len(FEATURES)
    signs = [FEATURES.index(f) for f in SIGNS]
    n_poor = sum(q == 0 for q, _ in sample)
    # sequences of like length share an array
    by_width: dict[int, list] = {}
    for q, codes in sample:
        by_width.setdefault(1 << (len(codes) - 1).bit_length(), []).append((q, codes))
    parts = []
    for width, rows in sorted(by_width.items()):
        mask, x = np.zeros((len(rows), width)), np.zeros((len(rows), width, k))
        truth, weight = np.zeros((len(rows), width, 2)), np.zeros(len(rows))
        for i, (q, codes) in enumerate(rows):
            mask[i, :len(codes)] = 1
            x[i, :len(codes)] = (np.array(codes)[:, None] >> np.arange(k)) & 1
            junk = (q == 0) & (x[i][:, signs].sum(1) > 0)
            truth[i] = np.eye(2)[np.where(junk, BOILERPLATE, CONTENT)] * mask[i, :, None]
            # each document weighs the same, and so does each class
            weight[i] = 0.5 / (n_poor if q == 0 else len(sample) - n_poor) / len(codes)
        parts.append((x, mask, truth, weight))
    w, t = np.zeros((2, k)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(t), np.zeros_like(w), np.zeros_like(t)]
    for step in range(1, steps + 1):
        grads = [-l2 * w, -l2 * t]
        for part in parts:
            for g, d in zip(grads, _crf_gradients(w, t, *part)):
                g += d
        for i, (p, g) in enumerate(zip((w, t), grads)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 2] = 0.999 * moments[i + 2] + 0.001 * g * g
            p += rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 2] / (1 - 0.999**step)) + 1e-8)
    return Crf(w, t)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def _crf_gradients(w, t, x, mask, truth, weight) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the weighted log likelihood of padded sequences, by forward
    and backward sums."""
    e = x @ w.T
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0]
    width = e.shape[1]
    for j in range(1, width):
        new = e[:, j] + _lse(alpha[:, j - 1][:, :, None] + t, 1)
        alpha[:, j] = np.where(mask[:, j, None] > 0, new, alpha[:, j - 1])
    for j in range(width - 2, -1, -1):
        new = _lse(t + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
        beta[:, j] = np.where(mask[:, j + 1, None] > 0, new, 0)
    z = _lse(alpha[:, -1], 1)
    state = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
    pair = np.exp(alpha[:, :-1, :, None] + t + (e + beta)[:, 1:, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
    gold_pair = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    return (np.einsum("njs,njk,n->sk", truth - state, x, weight, optimize=True),
            np.einsum("njab,n->ab", gold_pair - pair, weight, optimize=True))


def train(docs: DataFrame, labels: DataFrame) -> Crf:
    return fit_crf(fit_sample(docs, labels))
