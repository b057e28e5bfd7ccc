"""Target-distribution importance resampling over hashed word runs.

Words come from an untrained pre-tokenizer of the tokenizers library: a Split by
regular expression over the text with A-Z lower-cased, which returns each word
with its offsets. A feature is a window of consecutive words: a pair of offsets,
from the first word's start to the last word's end, in the words joined by one
space. Its bucket is the CRC-32 of those bytes modulo ``buckets``.

One pass over the documents writes the buckets of each text (two bytes a
feature); a bucket histogram of all rows and one of the target texts give every
bucket its gain; a second pass over the written buckets sums the gains. A
Gumbel draw seeded by the id is added, and the highest ``percent`` of the
documents with at least ``min_words`` words are drawn without replacement, ranked
by prefix sums over ranges of the score (``operators.ranks``).

To the driver come two histograms of at most ``buckets`` rows and two counts.

Results in odd cases: a null or empty text, or one without words, has no features,
weight 0 and its Gumbel draw as score; a null id is hashed as an empty string and
sorts first among ties; repeated rows are documents of their own, ranked one
after the other; an empty corpus gives an empty result; an empty target table
leaves every gain at the value of no target word; bytes that are no UTF-8 count
as U+FFFD; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import blocks, byte_view
from ledgerwise.operators.ranks import prefix_sums
from ledgerwise.session import materialize

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE_BYTES = 1 << 20     # a longer text is cut at spaces between words
MEMO_FEATURES = 300_000   # buckets a worker remembers
GUMBEL_RANGE = 4294967296.0

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex, pre_tokenizers
    return pre_tokenizers.Split(Regex(WORD_PATTERN), behavior="removed", invert=True)


def _pieces(text: bytes) -> Iterator[str]:
    """The text in pieces of about ``PIECE_BYTES``; a space never lies in a word."""
    lo = 0
    while lo < len(text):
        hi = lo + PIECE_BYTES
        if hi < len(text):
            cut = text.find(b" ", hi)
            hi = cut if cut >= 0 else len(text)
        yield text[lo:hi].decode("utf-8", "replace")
        lo = hi


class Featurizer:
    """Buckets of all windows of ``shortest`` to ``longest`` words of a text."""

    def __init__(self, shortest: int, longest: int, buckets: int):
        if not 1 <= shortest <= longest:
            raise ValueError("window lengths must be 1 <= shortest <= longest")
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
        self.memo: dict[str, int] = {}

    def _bucket(self, feature: str) -> int:
        b = crc32(feature.encode()) % self.buckets
        if len(self.memo) >= MEMO_FEATURES:
            self.memo.clear()
        self.memo[feature] = b
        return b

    def text(self, raw: bytes) -> tuple[int, np.ndarray]:
        """(words, buckets of the features) of one whole text."""
        n_words, out, carry = 0, [], []
        known, split = self.memo.get, _splitter().pre_tokenize_str
        for piece in _pieces(raw.translate(_LOWER)):
            found = split(piece)
            if not found:
                continue
            n_words += len(found)
            words = carry + [w for w, _ in found]
            lengths = np.array([len(w) for w in carry] + [hi - lo for _, (lo, hi) in found])
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths).tolist()
            ends = ends.tolist()
            joined, fresh = " ".join(words), len(carry)
            for n in range(self.shortest, self.longest + 1):
                # windows that end in this piece; the others were taken with the last
                first = max(0, fresh - n + 1)
                for lo, hi in zip(starts[first:], ends[first + n - 1:]):
                    feature = joined[lo:hi]
                    b = known(feature)
                    out.append(self._bucket(feature) if b is None else b)
            carry = words[len(words) - self.longest + 1:] if self.longest > 1 else []
        return n_words, np.array(out, dtype=self.dtype)


def features(docs: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the buckets as packed integers."""
    def run(batches):
        f = Featurizer(shortest, longest, buckets)
        for b in blocks(batches, "text"):
            buf, off = byte_view(b.column("text"))
            raw = buf.tobytes()
            got = [f.text(raw[lo:hi]) for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _ in got], pa.int64()), pa.array([len(x) for _, x in got], pa.int64()),
                 pa.array([x.tobytes() for _, x in got], pa.binary())], ["doc_id", "n_words", "n_features", "buckets"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary")


def _packed(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of packed integers."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]].view(dtype) if data is not None else np.zeros(0, dtype)
    return values, (off - off[0]) // dtype.itemsize


def histogram(feats: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows: every task sums its own before the shuffle."""
    dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                total += np.bincount(_packed(b.column("buckets"), dtype)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = feats.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed raw share) of each bucket."""
    k = len(raw)
    big_s, big_t = int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000.0 * math.log((t + 1) * (big_s + k) / ((s + 1) * (big_t + k))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def weights(feats: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of the gains of a text's features."""
    dtype = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches):
        for b in batches:
            values, off = _packed(b.column("buckets"), dtype) if b.num_rows else (np.zeros(0, dtype), np.zeros(1, np.int64))
            sums = np.concatenate(([0], np.cumsum(gain[values])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), b.column("n_features"), pa.array(sums[off[1:]] - sums[off[:-1]])],
                ["doc_id", "n_words", "n_features", "weight"])

    return feats.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id, seed: int):
    """floor(1000 x a standard Gumbel draw), from the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(GUMBEL_RANGE)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000,
             min_words: int = 20, percent: int = 10, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``;
    rank is null unless the row is drawn."""
    feats = materialize(features(docs, shortest, longest, buckets, id_col, text_col), "importance-buckets")
    wanted = features(target.select(F.lit(0).alias("doc_id"), F.col(target_col).alias("text")), shortest, longest, buckets)
    gain = gains(histogram(feats, buckets), histogram(wanted, buckets))
    n_draw = feats.filter(F.col("n_words") >= min_words).count() * percent // 100
    scored = weights(feats, gain).select(
        "*", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"))
    # those that may be drawn first, then by falling score; equal keys are equal rows but for their rank
    keyed = scored.select("*", (F.col("n_words") < min_words).alias("_late"), (-F.col("score")).alias("_down"), F.lit(1).alias("_one"))
    ranked = prefix_sums(keyed, ["_late", "_down", "doc_id", "weight", "n_features"], ["_one"])
    place = (F.col("_before__one") + 1).cast("long")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(~F.col("_late") & (place <= n_draw), place).alias("rank"))


def drawn(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are drawn; a repeated id is drawn with all its rows."""
    ids = resample(docs, target, **how).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    key = F.col(how.get("id_col", "doc_id")).cast("long")
    return docs.join(ids, key.eqNullSafe(F.col("_drawn")), "left_semi")
