"""Substring dedup on a De Bruijn graph of word k-mers, compacted by Spark joins.

The edges of the graph are windows of ``window`` consecutive words. A document
is a walk over edges; a window that also starts in a document with a smaller id
is a repeated edge, and all words under it go.

Edges are carried compacted. Each window has an anchor: the smallest hash of the
``anchor``-word runs inside it. Consecutive windows with one anchor form a
piece, a path of edges stored as one row (anchor, digest of all its words, doc,
start, number of windows). Equal windows have equal anchors wherever they stand,
so an anchor met in one document only rules out all its windows at once
(a join drops those pieces). Of the others

* equal pieces (anchor and digest, 128 bits) are one nonbranching path:
  grouping them gives its source, the smallest document that holds it, and a
  join brings every occurrence to its source coordinate;
* where an anchor has several different pieces the graph branches. Only there,
  and only in each piece's source document, the piece is expanded into single
  edges (the words are fetched again by a join with the texts), which are
  grouped and joined in the same way.

Repeated edges with consecutive coordinates in a text and in their source
compact into spans (doc_id, start, end, source_doc, source_start), and a join
of the texts with their spans yields what is kept. Every grouping is by a key
of 128 bits with map-side combine; copies of a passage are compared with the
passage's source, never with each other, so the work is linear in the words.
Grouped tables are written before rows are joined to them: both sides of the
join are then plain shuffles, of which adaptive execution can split a hot key.

Results in odd cases: a null or empty text has no words; rows of one doc_id are
one document and never remove each other's words; a null id counts as larger
than any other; texts shorter than a window lose nothing; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Hasher, Words, blocks, signed, text_of
from ledgerwise.session import materialize

NO_ID = (1 << 63) - 1  # stands for a null id inside
BLOCK_BYTES = 2 << 20
_SEEDS = (1, 2)
_hashers: list[Hasher] = []


def _two_hashers() -> list[Hasher]:
    if not _hashers:
        _hashers.extend(Hasher(s) for s in _SEEDS)
    return _hashers


def _sliding_min(h: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` neighbours, by doubling."""
    out, have = h, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class _Windows:
    """Anchors of all windows of a block, and the second hash's prefix sums."""

    def __init__(self, column: pa.Array, window: int, anchor: int):
        first, second = _two_hashers()
        self.window = window
        w = self.words = Words(column)
        counts = np.maximum(w.counts - window + 1, 0)
        total = int(counts.sum())
        begin = np.concatenate(([0], np.cumsum(counts)))
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.at = np.arange(total) - np.repeat(begin[:-1] - w.first[:-1], counts)
        self.sums = second.prefix(second.words(w)) if total else np.zeros(1, np.uint64)
        if total:
            runs = np.arange(len(w.starts) - anchor + 1)
            h = first.runs(first.prefix(first.words(w)), runs, runs + anchor)
            self.anchor = _sliding_min(h, window - anchor + 1)[self.at]
        else:
            self.anchor = np.zeros(0, np.uint64)

    def batch(self, b: pa.RecordBatch, i: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """Pieces of n windows from the i-th windows of the block on."""
        at, doc = self.at[i], self.doc[i]
        digest = _two_hashers()[1].runs(self.sums, at, at + n + self.window - 1)
        columns = {"anchor": signed(self.anchor[i]), "digest": signed(digest),
                   "doc": b.column("doc").to_numpy(zero_copy_only=False)[doc],
                   "row": b.column("row").to_numpy(zero_copy_only=False)[doc],
                   "start": (at - self.words.first[doc]).astype(np.int32), "n": n.astype(np.int32)}
        return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


PIECE = "anchor long, digest long, doc long, row int, start int, n int"


def _pieces(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """All pieces of ``texts(doc, row, text)``."""
    def run(batches):
        for b in blocks(batches, "text", BLOCK_BYTES):
            x = _Windows(b.column("text"), window, anchor)
            head = np.ones(len(x.at), dtype=bool)
            if len(head):
                head[1:] = (x.anchor[1:] != x.anchor[:-1]) | (x.doc[1:] != x.doc[:-1])
            i = np.flatnonzero(head)
            n = np.diff(np.concatenate((i, [len(head)])))
            yield x.batch(b, i, n)

    return texts.mapInArrow(run, PIECE)


def _edges(wanted: DataFrame, window: int, anchor: int) -> DataFrame:
    """Single edges (n = 1) of the pieces listed in ``wanted(doc, row, text, pieces)``."""
    def run(batches):
        for b in blocks(batches, "text", BLOCK_BYTES):
            x = _Windows(b.column("text"), window, anchor)
            pieces = b.column("pieces")
            owner = np.repeat(np.arange(b.num_rows), pieces.value_lengths().to_numpy())
            flat = pieces.flatten()
            start, n = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
            begin = np.concatenate(([0], np.cumsum(np.maximum(x.words.counts - window + 1, 0))))
            # rank of every wanted window among all windows of the block
            rank = np.repeat(begin[owner] + start, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            yield x.batch(b, rank, np.ones(len(rank), dtype=np.int64))

    return wanted.mapInArrow(run, PIECE)


def _with_source(paths: DataFrame) -> DataFrame:
    """Per distinct path (anchor, digest, n): source coordinate and whether a
    second document holds it."""
    return paths.groupBy("anchor", "digest", "n").agg(
        F.min(F.struct("doc", "start")).alias("source"), F.max("doc").alias("last"))


def _occurrences(paths: DataFrame, classes: DataFrame) -> DataFrame:
    """Occurrences outside the source document, at their source coordinate."""
    shared = classes.filter("last > source.doc").select("anchor", "digest", "n", "source")
    return (paths.join(shared, ["anchor", "digest", "n"]).filter("doc > source.doc")
            .select("doc", "row", "start", "n", F.col("source.doc").alias("source_doc"), F.col("source.start").alias("source_start")))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, text): row tells texts under one id apart."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.hash(text_col).alias("row"), F.col(text_col).cast("string").alias("text"))


def repeated_edges(docs: DataFrame, window: int = 50, anchor: int = 10,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, start, n, source_doc, source_start): windows start .. start+n-1 of a
    document that also start in the source document, which has a smaller id."""
    texts = _texts(docs, id_col, text_col)
    pieces = materialize(_pieces(texts, window, anchor), "pieces")
    twice = pieces.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    twice = materialize(twice.select("anchor"), "shared-anchors")
    shared = materialize(pieces.join(twice, "anchor"), "shared-pieces")
    classes = materialize(_with_source(shared), "piece-classes")
    whole = _occurrences(shared, classes)

    branching = classes.groupBy("anchor").agg(F.count("*").alias("ways")).filter("ways > 1").select("anchor")
    branching = materialize(branching, "branching-anchors")
    ways = classes.join(branching, "anchor").select("anchor", "digest", "n", F.col("source.doc").alias("source_doc"))
    ways = materialize(ways, "branching-pieces")
    split = (shared.join(ways, ["anchor", "digest", "n"]).filter("doc = source_doc")
             .groupBy("doc", "row").agg(F.collect_list(F.struct("start", "n")).alias("pieces")))
    edges = materialize(_edges(texts.join(split, ["doc", "row"]).select("doc", "row", "text", "pieces"), window, anchor), "branch-edges")
    single = _occurrences(edges, materialize(_with_source(edges).filter("last > source.doc"), "edge-classes"))
    return whole.unionByName(single)


def repeated_spans(edges: DataFrame, window: int = 50) -> DataFrame:
    """(doc, row, start, end, source_doc, source_start): runs of repeated edges that
    are consecutive in the document and in the source, as words start .. end-1."""
    order = W.partitionBy("doc", "row").orderBy("start", "n")
    shift = F.col("source_start") - F.col("start")
    new = ((F.lag(F.col("start") + F.col("n")).over(order) != F.col("start"))
           | (F.lag("source_doc").over(order) != F.col("source_doc")) | (F.lag(shift).over(order) != shift))
    marked = edges.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    return (marked.withColumn("path", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
            .groupBy("doc", "row", "path")
            .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n") + F.lit(window - 1)).alias("end"),
                 F.min("source_doc").alias("source_doc"), F.min("source_start").alias("source_start"))
            .drop("path"))


def _kept(texts: DataFrame) -> DataFrame:
    def run(batches):
        for b in blocks(batches, "text", BLOCK_BYTES):
            w = Words(b.column("text"))
            joined, starts, ends = w.joined(w.buf)
            spans = b.column("spans")
            lengths = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(b.num_rows), lengths)
            flat = spans.flatten()
            step = np.zeros(len(w.starts) + 1, np.int32)
            for field, sign in (("start", 1), ("end", -1)):
                np.add.at(step, w.first[owner] + flat.field(field).to_numpy(zero_copy_only=False).astype(np.int64), sign)
            gone = np.cumsum(step[:-1]) > 0
            cover = np.concatenate(([0], np.cumsum(gone)))
            removed = cover[w.first[1:]] - cover[w.first[:-1]]
            texts_out = []
            for d in range(b.num_rows):
                lo, hi = int(w.first[d]), int(w.first[d + 1])
                if removed[d] == 0:
                    texts_out.append(text_of(joined, starts, ends, lo, hi).decode("utf-8", "replace"))
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([True], gone[lo:hi], [True])).astype(np.int8)))
                runs = [text_of(joined, starts, ends, lo + a, lo + z) for a, z in edge.reshape(-1, 2).tolist()]
                texts_out.append(b" ".join(runs).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(w.counts.astype(np.int64)), pa.array(removed.astype(np.int64)),
                 pa.array(texts_out, pa.string())], ["doc", "n_words", "n_removed", "kept"])

    return texts.mapInArrow(run, "doc long, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, window: int = 50, anchor: int = 10,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by one space."""
    spans = repeated_spans(repeated_edges(docs, window, anchor, id_col, text_col), window)
    by_doc = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = _texts(docs, id_col, text_col).join(by_doc, ["doc", "row"], "left").select("doc", "text", "spans")
    return _kept(both).select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")
