"""Near-duplicate documents by SimHash with multi-index hashing.

``fingerprints``: 64-bit SimHash of each whole text (Arrow batches).
``links``: the 64 bits are cut into segments; for every segment, the table
holds each fingerprint under all keys of the segment's Hamming ball of radius
one, the other segments' bits kept. Two fingerprints that differ in at most
two bits meet under a common key (flip one of the two bits on either side), so
one table lookup finds all of them, and a key's bucket can hold no more than
65 fingerprints: its centre and the centre with one bit flipped. The bucket is
kept as a bit mask, so no pair list is built, however many documents or
fingerprints resemble each other. Every link's complete distance is checked.
``near_duplicates``: components of the links, spread to all documents; the rows of
a hot fingerprint are dealt out by a salt for that.

Results in odd cases: a null or empty text, or one of separators only, has
fingerprint zero and links like any other; repeated rows of a document id get
the same class; a document id of null gets a class like any other row (its
component_id is the smallest non-null id of the component, null if none); an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import Words, blocks
from ledgerwise.llm.graph import components
from ledgerwise.session import materialize

BITS = 64
SEGMENTS = 4
HOT_SHARE = 1_000   # a fingerprint of more than a thousandth of all rows is hot
SALTS = 32          # parts that its rows are dealt into


def simhash_block(column: pa.Array, shingle: int, seed: int = 42) -> np.ndarray:
    """The 64-bit SimHash of each text, as unsigned integers."""
    w = Words(column)
    n_docs = len(w.counts)
    out = np.zeros(n_docs, dtype=np.uint64)
    text, starts, ends = w.joined(w.lowered())
    counts = np.maximum(w.counts - shingle + 1, np.minimum(w.counts, 1))
    total = int(counts.sum())
    if total == 0:
        return out
    begin = np.concatenate(([0], np.cumsum(counts)))
    # first word of every shingle, and the word behind its last
    word = np.arange(total) - np.repeat(begin[:-1] - w.first[:-1], counts)
    behind = np.minimum(word + shingle, np.repeat(w.first[1:], counts))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b], seed) for a, b in zip(starts[word].tolist(), ends[behind - 1].tolist())),
                    dtype=np.uint64, count=total)
    full = np.flatnonzero(counts)
    ones = np.zeros((len(full), BITS), dtype=np.int64)
    step = 1 << 16  # shingles whose bits are unpacked at a time
    owner = np.repeat(np.arange(len(full)), counts[full])
    for lo in range(0, total, step):
        part = h[lo:lo + step]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[lo:lo + step]
        edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        ones[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    major = (2 * ones > counts[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, fp): fp is the SimHash as a signed long, content XXH64 of the text."""
    def run(batches):
        for b in blocks(batches, "text"):
            fp = simhash_block(b.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("content"), pa.array(fp.view(np.int64))], ["doc_id", "content", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("content"))
    return src.mapInArrow(run, "doc_id long, content long, fp long")


def _flips(segments: int) -> list[int]:
    """Single-bit masks, segment by segment, as signed longs."""
    width = BITS // segments
    bits = [s * width + b for s in range(segments) for b in range(width)]
    return [(1 << b) - (1 << 64) if b == 63 else 1 << b for b in bits]


def links(fps: DataFrame, max_bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """(u, v): links between different fingerprints of ``fps(fp)`` (distinct)
    that connect every pair within ``max_bits`` (0 to 2) differing bits, in one
    or two steps through a common neighbour. Per bucket one star, at most 64 links."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the ball enumeration covers max_bits 0, 1 and 2")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    # a set number of partitions: adaptive execution would size them by the
    # fingerprints, which the table holds 65 times (by a hash of fp, as a plain
    # repartition by fp is left out after a grouping by fp)
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(parts, F.xxhash64("fp"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(m) for m in _flips(segments)])
    table = (fps.select("fp", F.explode(flips).alias("flip"))
             .select(F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "flip"))
    buckets = table.groupBy("key").agg(
        F.bit_or("flip").alias("mask"), F.count("*").alias("n"), F.max(F.col("flip") == 0).alias("centre"))
    members = F.filter(flips, lambda m: F.when(m == 0, F.col("centre"))
                       .otherwise(m.bitwiseAND(F.col("mask")) != 0))
    shared = (buckets.filter("n > 1")
              .select("centre", F.transform(members, lambda m: m.bitwiseXOR(F.col("key"))).alias("fps")))
    if max_bits == 1:  # only the centre is within one bit of the others; it comes first
        shared = shared.filter("centre")
        star = shared.select(F.element_at("fps", 1).alias("u"), F.explode("fps").alias("v"))
    else:
        star = shared.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v"))
    return star.filter((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, fp, component_id): the smallest doc_id reachable over links."""
    each = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    classes = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-fp")
    roots = components(links(classes.select("fp"), max_bits))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "simhash-class")
    # written, so that the join can split a root that holds many fingerprints
    lows = materialize(placed.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-low")
    by_fp = placed.join(lows, "root").select("fp", "n", "component_id")
    return _spread(each, by_fp)


def _spread(each: DataFrame, by_fp: DataFrame) -> DataFrame:
    """Each row's class. A fingerprint of more than one row in ``HOT_SHARE`` is dealt out by a salt,
    its class repeated for each; there are fewer than ``HOT_SHARE`` of them."""
    total = each.count()
    hot = [r["fp"] for r in by_fp.filter(F.col("n") > total / HOT_SHARE).select("fp").collect()]

    def salts(of_rows: F.Column, of_classes: F.Column) -> tuple[F.Column, F.Column]:
        if not hot:
            return F.lit(0), F.array(F.lit(0))
        is_hot = F.col("fp").isin(hot)
        return F.when(is_hot, of_rows).otherwise(F.lit(0)), F.when(is_hot, of_classes).otherwise(F.array(F.lit(0)))

    row_salt, class_salts = salts(F.pmod(F.xxhash64("doc_id", "content"), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
    rows = each.withColumn("salt", row_salt)
    classes = by_fp.select("fp", "component_id", F.explode(class_salts).alias("salt"))
    return rows.join(classes, ["fp", "salt"]).select("doc_id", "content", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of which each class keeps those with its smallest doc_id (all of
    its rows in that class; rows without an id are kept). An id whose rows lie in
    several classes is judged in each of them, so every class keeps a row."""
    found = near_duplicates(docs, shingle, max_bits)
    drop = found.filter(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("_drop_id"), F.col("content").alias("_drop_content")).distinct()
    # a row is known by its id and the hash of its text, which the first pass carried along
    same = (F.col("doc_id").cast("long") == F.col("_drop_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_drop_content"))
    return docs.join(drop, same, "left_anti")


def hex_fingerprint(fp: F.Column) -> F.Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
