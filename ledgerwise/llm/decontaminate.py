"""Benchmark decontamination by SimHash of item-sized windows and multi-index Hamming blocks.

Words are whole-text words with A-Z lower-cased; an item's shingles have five
words (all of them, if it has fewer). A document leaks an item if some window of
the item's length (the whole document, if it is shorter) has a weighted Jaccard
similarity of at least ``min_similarity`` with it: sum of the smaller over sum
of the larger multiplicities of the shingles.

The item side comes in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_CHARS``
characters (more blocks, not fewer items, for a larger benchmark), sent to the
tasks with the code; documents never move. Per block of items one pass:

1. Windows that share no shingle with an item have similarity zero, so only
   windows around shared shingles get a fingerprint.
2. The 128-bit SimHash of each such window is looked up in ``CHUNKS`` tables of
   8-bit blocks. Every table lists the items within a Hamming ball of
   ``RADIUS // CHUNKS`` bits, so an item within ``RADIUS`` bits of the window is found
   in at least one table. The fingerprint's elements are pairs of a shingle and
   its occurrence number in the window, all distinct, so one repeated shingle is
   many elements and can't outvote the rest, and the weighted similarity is that
   of two sets. At 0.8 a bit differs with probability 0.152 (angle of two sets of
   one size), 19.5 of 128 expected with a deviation of 4.1: the radius of 40 lies
   five deviations off (3.6 at worst, for texts of four shingles against five).
3. The complete Hamming distance, then the exact similarity decide.

Results in odd cases: null or empty texts and items match nothing; repeated
items of an id give one row per (doc_id, item_id), repeated document rows one row
each; null ids stay null; an empty benchmark or document table gives an empty
result; further columns stay in ``remove_contaminated`` and are ignored otherwise.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Hasher, Words, blocks, scramble

SHINGLE = 5
CHUNKS, RADIUS = 16, 40  # 16 blocks of 8 bits
BLOCK_ITEMS, BLOCK_CHARS = 4_096, 8_000_000
BLOCK_BYTES = 1 << 20
_SALT = np.uint64(0x9E3779B97F4A7C15)
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def window_fingerprints(shingles: np.ndarray, run: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(windows, 16 bytes): SimHash of ``shingles[start : start + size[start]]``, in
    which the first, second, ... occurrence of a shingle are elements of their own.
    ``run`` numbers the stretches that windows do not cross, ``size`` is the same
    throughout a run."""
    n = len(shingles)
    at = np.arange(n)
    begin = np.searchsorted(run, run)
    group = np.unique(shingles, return_inverse=True)[1]
    group = np.unique(run * (int(group.max(initial=0)) + 1) + group, return_inverse=True)[1] * n
    key = np.sort(group + at)

    def count(lo, hi):  # of each position's shingle within its run
        return np.searchsorted(key, group + hi, "right") - np.searchsorted(key, group + lo, "left")

    # from a window to the next one, a shingle's last occurrence number goes and comes
    enter = count(np.maximum(at - size + 1, 0), at).astype(np.uint64)
    leave = count(at, np.minimum(at + size - 1, n - 1)).astype(np.uint64)
    later = np.flatnonzero(at - size >= begin)
    gone = later - size[later]
    new, old = scramble(shingles ^ scramble(enter)), scramble(shingles[gone] ^ scramble(leave[gone]))
    length = size[start]
    out = np.empty((len(start), CHUNKS), dtype=np.uint8)
    for half in (0, 1):
        if half:
            new, old = scramble(new ^ _SALT), scramble(old ^ _SALT)
        change = np.unpackbits(new.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.int8)
        change[later] -= np.unpackbits(old.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.int8)
        sums = np.zeros((n + 1, 64), dtype=np.int32)
        np.cumsum(change, axis=0, out=sums[1:])
        major = 2 * (sums[start + length] - sums[begin[start]]) > length[:, None]
        out[:, 8 * half:8 * half + 8] = np.packbits(major, axis=1, bitorder="little")
    return out


class ItemClass:
    """Items of one length: multisets, fingerprints and the ball tables."""

    def __init__(self, n: int):
        self.n, self.k = n, min(SHINGLE, n)
        self.ids: list = []
        self.counts: list[Counter] = []
        self.prints: list[np.ndarray] = []

    def finish(self) -> None:
        self.prints = np.stack(self.prints)
        lanes = -(-len(self.ids) // 64)
        self.tables = np.zeros((CHUNKS, 256, lanes), dtype=np.uint64)
        near = _POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // CHUNKS
        for j, fp in enumerate(self.prints):
            for c in range(CHUNKS):
                self.tables[c, near[fp[c]], j // 64] |= np.uint64(1 << (j % 64))

    def candidates(self, prints: np.ndarray):
        """(item, windows within RADIUS bits) for the items any table lists."""
        listed = np.zeros((len(prints), self.tables.shape[2]), dtype=np.uint64)
        for c in range(CHUNKS):
            listed |= self.tables[c][prints[:, c]]
        for j in range(len(self.ids)):
            at = np.flatnonzero(listed[:, j // 64] >> np.uint64(j % 64) & np.uint64(1))
            if len(at):
                yield j, at[_POPCOUNT[prints[at] ^ self.prints[j]].sum(axis=1) <= RADIUS]


class ItemIndex:
    """A bounded block of items, by length, with the shingles they hold."""

    def __init__(self, items: list[tuple[int, str]]):
        self.hasher = Hasher(9)
        w = Words(pa.array([t for _, t in items], pa.string()))
        sums = self.hasher.prefix(self.hasher.words(w, w.lowered()))
        self.classes: dict[int, ItemClass] = {}
        holders: dict[int, dict[int, set[int]]] = {}
        for i, (item_id, _) in enumerate(items):
            lo, n = int(w.first[i]), int(w.counts[i])
            if n == 0:
                continue
            c = self.classes.setdefault(n, ItemClass(n))
            at = np.arange(lo, lo + n - c.k + 1)
            h = self.hasher.runs(sums, at, at + c.k)
            c.ids.append(item_id)
            c.counts.append(Counter(h.tolist()))
            c.prints.append(window_fingerprints(h, np.zeros(len(h), np.int64), np.full(len(h), len(h)), np.array([0]))[0])
            for x in h.tolist():
                holders.setdefault(c.k, {}).setdefault(x, set()).add(n)
        for c in self.classes.values():
            c.finish()
        # by shingle length: sorted shingles, and the item lengths that hold each
        self.holders = {}
        for k, by in holders.items():
            keys = np.array(sorted(by), dtype=np.uint64)
            lengths = [sorted(by[x]) for x in keys.tolist()]
            first = np.concatenate(([0], np.cumsum([len(x) for x in lengths])))
            self.holders[k] = (keys, first, np.array([n for x in lengths for n in x]))

    def matches(self, column: pa.Array, min_similarity: float):
        """(text, item_id, first word of the best window, windows, similarity)."""
        w = Words(column)
        if not self.classes or not len(w.starts):
            return
        sums = self.hasher.prefix(self.hasher.words(w, w.lowered()))
        doc_of = np.repeat(np.arange(len(w.counts)), w.counts)
        for k, (keys, first, lengths) in self.holders.items():
            total = len(w.starts) - k + 1
            if total <= 0:
                continue
            at = np.arange(total)
            h = self.hasher.runs(sums, at, at + k)  # those across texts are never used
            slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero((keys[slot] == h) & (doc_of[:total] == doc_of[k - 1:]))
            if not len(hit):
                continue
            reps = first[slot[hit] + 1] - first[slot[hit]]
            pos = np.repeat(hit, reps)
            offset = np.arange(len(pos)) - np.repeat(np.cumsum(reps) - reps, reps)
            n_of = lengths[np.repeat(first[slot[hit]], reps) + offset]
            for n in np.unique(n_of).tolist():
                yield from self._of_class(self.classes[n], w, doc_of, h, pos[n_of == n], min_similarity)

    def _of_class(self, c: ItemClass, w: Words, doc_of, h, hits, min_similarity):
        doc = doc_of[hits]
        size = np.minimum(c.n, w.counts[doc])  # words of a window in that text
        lo = np.maximum(w.first[doc], hits - (size - c.k))
        hi = np.minimum(hits, w.first[doc + 1] - size)
        mark = np.zeros(len(w.starts) + 1, dtype=np.int32)
        np.add.at(mark, lo, 1)
        np.add.at(mark, hi + 1, -1)
        start = np.flatnonzero(np.cumsum(mark[:-1]))
        doc = doc_of[start]
        length = np.minimum(c.n, w.counts[doc]) - c.k + 1  # shingles of the window
        cover = np.zeros(len(w.starts) + 1, dtype=np.int32)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + length, -1)
        covered = np.flatnonzero(np.cumsum(cover[:-1]))
        of = doc_of[covered]
        run = np.cumsum((np.diff(covered, prepend=-1) != 1) | (np.diff(of, prepend=-1) != 0))
        prints = window_fingerprints(h[covered], run, np.minimum(c.n, w.counts[of]) - c.k + 1, np.searchsorted(covered, start))
        for j, at in c.candidates(prints):
            item, whole = c.counts[j], c.n - c.k + 1
            best: dict[int, list] = {}
            for i in at.tolist():
                s, m = int(start[i]), int(length[i])
                window = Counter(h[s:s + m].tolist())
                common = sum(min(x, item[key]) for key, x in window.items() if key in item)
                similarity = common / (m + whole - common)
                if similarity >= min_similarity:
                    d = int(doc[i])
                    b = best.setdefault(d, [0, 0, -1.0])
                    b[1] += 1
                    if similarity > b[2]:
                        b[0], b[2] = s - int(w.first[d]), similarity
            for d, (s, n, similarity) in best.items():
                yield d, c.ids[j], s, n, similarity


def _item_blocks(benchmark: DataFrame) -> list[ItemIndex]:
    """The items in blocks of a bounded size, read from the benchmark one by one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    n, chars = items.agg(F.count("*"), F.sum(F.char_length("text"))).first()
    # blocks of half the bounds on average, as the hash deals unevenly
    parts = max(1, -(-2 * n // BLOCK_ITEMS), -(-2 * (chars or 0) // BLOCK_CHARS)) if n > BLOCK_ITEMS // 2 or (chars or 0) > BLOCK_CHARS // 2 else 1
    out = []
    for i in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).distinct().collect()
        if rows:
            out.append(ItemIndex(sorted(((r.item_id, r.text) for r in rows), key=repr)))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, min_similarity: float = 0.8,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_windows, similarity): one row for each
    document row and leaked item, with its best window (the first, if tied)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, start_word long, n_windows long, similarity double"
    out = None
    for index in _item_blocks(benchmark):
        def run(batches, index=index):
            for b in blocks(batches, "text", BLOCK_BYTES):
                ids = b.column("doc_id")
                best: dict = {}
                for d, item, s, n, similarity in index.matches(b.column("text"), min_similarity):
                    old = best.get((d, item))
                    if old is None or similarity > old[2]:
                        best[d, item] = (s, n, similarity)
                rows = [(ids[d].as_py(), item, *x) for (d, item), x in best.items()]
                cols = list(zip(*rows)) if rows else [()] * 5
                types = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)],
                                                 ["doc_id", "item_id", "start_word", "n_windows", "similarity"])
        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, min_similarity: float = 0.8,
                        text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, one pass for each block of items, no shuffle."""
    for index in _item_blocks(benchmark):
        def run(batches, index=index):
            for b in blocks(batches, text_col, BLOCK_BYTES):
                keep = np.ones(b.num_rows, dtype=bool)
                for d, *_ in index.matches(b.column(text_col), min_similarity):
                    keep[d] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
