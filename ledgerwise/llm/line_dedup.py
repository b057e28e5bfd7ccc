"""Line dedup over levelled sorted runs of line hashes, with DataFrame functions only.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased; keys shorter than ``min_chars`` code points are left alone. A key
is carried as (64-bit hash, 32-bit hash, length).

``LineRuns`` is a levelled store of runs (key, n_docs, last_doc), each sorted
by key within hash partitions, under the shared checkpoint folder. Batches come
from the largest doc_ids down, so a key's ``last_doc`` is final when the key
first appears, and a key that has reached ``min_docs`` is settled: a new batch
merge-anti-joins the settled keys of the runs and adds a run of its remaining
keys; when a level holds ``fanout`` runs they are merged into one of the next
level. After the last batch the merged runs give every frequent key and the one
document that keeps its lines; lines are joined to them by key, and each text
is put together again from the slices between its dropped lines.

Results in odd cases: a null or empty text is one empty line; rows of one
doc_id are one document, each row loses its own lines; a null id is one
document below every other; equal lines within a document count once; an empty
table gives an empty result; further columns stay as they are, also such as
share the names used inside here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.session import materialize

KEY = ["k1", "k2", "klen"]
NO_ID = -(1 << 63)  # stands for a null id inside
STRIP = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: F.Column) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, text_hash, pos, k1, k2, klen) of every line long enough; ``docs``
    has the columns doc and text."""
    lines = docs.select("doc", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(STRIP)), UPPER, LOWER)
    return (lines.select("doc", "text_hash", "pos", key.alias("key"))
            .filter(F.char_length("key") >= min_chars)
            .select("doc", "text_hash", "pos", F.xxhash64("key").alias("k1"), F.hash("key").alias("k2"),
                    F.char_length("key").alias("klen")))


class LineRuns:
    """Levels of sorted runs of (key, n_docs, last_doc)."""

    def __init__(self, min_docs: int, fanout: int = 2):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        if len(runs) == 1:
            return every
        return every.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def frequent(self) -> DataFrame | None:
        """(key, last_doc) of the keys that have reached ``min_docs``."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        return self._merged(runs).filter(F.col("n_docs") >= self.min_docs).select(*KEY, "last_doc")

    def add(self, keys: DataFrame) -> None:
        """Adds a batch whose doc_ids are all below those of earlier batches."""
        fresh = keys.groupBy(*KEY).agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc"))
        settled = self.frequent()
        if settled is not None:
            fresh = fresh.join(settled.select(*KEY), KEY, "left_anti")
        run = materialize(fresh.sortWithinPartitions(*KEY), "line-run")
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            run = materialize(self._merged(self.levels[level]).sortWithinPartitions(*KEY), "line-run")
            self.levels[level] = []
            level += 1


def _batches(keys: DataFrame, n_batches: int) -> list[DataFrame]:
    """``keys`` cut into ranges of doc, the largest first; the last one holds all that is left."""
    low, high = keys.filter(F.col("doc") > NO_ID).agg(F.min("doc"), F.max("doc")).first()
    if low is None:
        return [keys]
    step = max(1, -(-(high - low + 1) // n_batches))
    tops = [high - i * step for i in range(n_batches) if high - i * step >= low]
    inner = [keys.filter((F.col("doc") > t - step) & (F.col("doc") <= t)) for t in tops[:-1]]
    return [*inner, keys.filter(F.col("doc") <= tops[-1])]


def dropped_positions(docs: DataFrame, min_chars: int, min_docs: int, n_batches: int, fanout: int) -> DataFrame:
    """(doc, text_hash, drops): sorted positions of the lines that go; ``docs``
    has the columns doc and text."""
    keys = materialize(line_keys(docs, min_chars), "line-keys")
    runs = LineRuns(min_docs, fanout)
    for batch in _batches(keys, n_batches):
        runs.add(batch)
    frequent = runs.frequent()
    if frequent is None:
        return keys.select("doc", "text_hash", F.array("pos").alias("drops")).limit(0)
    # written, so that the join can split a key that many lines have
    gone = keys.join(materialize(frequent, "frequent-lines"), KEY).filter(F.col("doc") != F.col("last_doc"))
    return gone.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drops"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4,
                        fanout: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their text without repeated lines, and the
    columns n_lines (before) and n_dropped at the end. A document that loses
    nothing keeps its text as it is; a null text stays null."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    gone = dropped_positions(docs.select(doc.alias("doc"), F.col(text_col).alias("text")),
                             min_chars, min_docs, n_batches, fanout)
    names = docs.columns
    row = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), doc.alias("doc"),
                      F.xxhash64(text_col).alias("text_hash"))
    both = row.join(gone, ["doc", "text_hash"], "left").select(
        "row", "drops", lines_of(F.col("row")[text_col]).alias("lines"))
    # slices between dropped positions: behind the i-th drop up to the next one
    edges = F.concat(F.array(F.lit(-1)), "drops", F.array(F.size("lines")))
    slices = F.transform(F.sequence(F.lit(1), F.size("drops") + 1),
                         lambda i: F.slice("lines", F.element_at(edges, i) + 2,
                                           F.element_at(edges, i + 1) - F.element_at(edges, i) - 1))
    text = F.when(F.col("drops").isNull(), F.col("row")[text_col]).otherwise(F.array_join(F.flatten(slices), "\n"))
    kept = both.select("row", F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("text"))
    extra = [c for c in ("n_lines", "n_dropped") if c not in names]
    return kept.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in names], *extra)


def dedup_documents(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with repeated lines dropped, under their own columns; n_chars
    follows the new text. Every row stays, also one that lost all its lines."""
    kept = drop_repeated_lines(docs, min_chars, min_docs)
    cols = [F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars" else F.col(c) for c in docs.columns]
    return kept.select(*cols)
