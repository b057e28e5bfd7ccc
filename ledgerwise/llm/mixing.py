"""Mixing sources to target weights by Poisson replication.

The mean target repetition rate of a source is ``weight * total / n`` (its
share of the weights, times the rows wanted, over the rows it has). Each
document draws its number of copies from a Poisson distribution of that mean by
inversion: a uniform number from the hash of (seed, doc_id) is compared with the
distribution's steps, which are tabulated once per source in log space (no
underflow at large rates), within 12 deviations of the mean: outside them the rest is
below double precision. A source's table thus has some 24 * sqrt(rate) + 40 entries,
made in linear time, and a document finds its count by binary search. Adaptive
execution sends the table to the documents where its size at run time allows, and else splits a
hot source's documents over tasks. Documents are exploded by their count and
dealt out by the hash of (seed, doc_id, copy), a global shuffle.

Results in odd cases: a null source is a source of its own; a source without a
weight, or with a weight of null, zero or less, gives no copies; a null doc_id
draws like the text 'null'; repeated rows of an id draw the same count, each
row is copied; null and empty texts are copied like others; an empty table gives
an empty result; further columns stay, and a column named like an added one is
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.session import materialize

DEVIATIONS = 12.0     # of the mean within which a distribution is tabulated


def uniform(*parts: F.Column) -> F.Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits, exact in a double."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def first_step(rate: F.Column) -> F.Column:
    """The smallest count of the table: below it the probabilities add up to nothing."""
    return F.greatest(F.lit(0), F.floor(rate - DEVIATIONS * F.sqrt(rate) - 40)).cast("long")


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``rates(source, rate)`` with ``low`` and ``steps``: P(X <= k) for k = low, low + 1, ... until
    the rest is below double precision. Running sums over one row a step."""
    low = first_step(F.col("rate"))
    last = F.ceil(F.col("rate") + DEVIATIONS * F.sqrt("rate") + 40).cast("long")
    # log k! of the first step by Stirling's series for large counts, else by its logarithms
    n = F.col("low").cast("double")
    series = n * F.log(n) - n + 0.5 * F.log(2 * math.pi * n) + 1 / (12 * n) - 1 / (360 * F.pow(n, 3)) + 1 / (1260 * F.pow(n, 5))
    exact = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest("low", F.lit(1).cast("long"))), F.lit(0.0), lambda a, k: a + F.log(k))
    start = F.when(F.col("low") == 0, -F.col("rate")).otherwise(
        n * F.log("rate") - F.col("rate") - F.when(F.col("low") > 100, series).otherwise(exact))
    each = rates.withColumn("low", low).withColumn("_start", start).select("*", F.explode(F.sequence("low", last)).alias("_k"))
    order = Window.partitionBy("source").orderBy("_k")
    log = F.col("_start") + F.sum(F.when(F.col("_k") > F.col("low"), F.log(F.col("rate") / F.col("_k"))).otherwise(0.0)).over(order)
    summed = each.withColumn("_log", log).withColumn("_step", F.sum(F.exp("_log")).over(order))
    # a few thousand steps a source at the rates of a mixture
    return summed.groupBy("source", "low").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_step"))), lambda x: x["_step"]).alias("steps"))


def count_of(u: F.Column, low: F.Column, steps: F.Column, longest: int) -> F.Column:
    """How many steps are at most ``u``, by binary search, above those left out below ``low``."""
    def halved(at: F.Column, step: int) -> F.Column:
        # the place found so far is named once, not nested into itself
        return F.transform(F.array(at), lambda i: i + F.when(F.try_element_at(steps, i + step) <= u, F.lit(step)).otherwise(F.lit(0)))[0]

    at, step = F.lit(0), 1 << max(longest.bit_length() - 1, 0)
    while step and longest:
        at, step = halved(at, step), step >> 1
    return low + at


def repetition_rates(docs: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """(source, n, rate) of ``weights(source, weight)`` for the sources of
    ``docs``; ``total`` rows wanted, as many as there are by default. Sources are
    counted with map-side sums."""
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    sums = weights.filter("weight > 0").agg(F.sum("weight").alias("all_weights"))
    have = n.agg(F.sum("n").alias("have")).select(F.lit(total).cast("double").alias("wanted"), "have") \
        .select(F.coalesce("wanted", F.col("have").cast("double")).alias("total"))
    w = weights.filter("weight > 0").select(F.col("source").alias("w_source"), "weight")
    one = sums.first()[0]
    want = have.first()[0]
    return (n.join(w, F.col("source").eqNullSafe(F.col("w_source")))
            .select("source", "n", (F.col("weight") / F.lit(one) * F.lit(want) / F.col("n")).alias("rate")))


def poisson_mix(docs: DataFrame, weights: DataFrame, total: float | None = None, seed: int = 11) -> DataFrame:
    """The copies: the columns of ``docs``, copy (from 1) and shuffle_key, dealt
    out and sorted by shuffle_key within partitions."""
    known = materialize(repetition_rates(docs, weights, total).select("source", "rate"), "mix-rates")
    table = materialize(poisson_steps(known), "mix-steps")
    longest = table.agg(F.max(F.size("steps"))).first()[0] or 0
    rates = table.select(F.col("source").alias("w_source"), "low", "steps")
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rows = docs.select(F.struct(*names).alias("row"))
    u = uniform(F.lit(seed), F.col("row.doc_id"))
    times = count_of(F.col("u"), F.col("low"), F.col("steps"), longest)
    drawn = (rows.join(rates, F.col("row.source").eqNullSafe(F.col("w_source")))
             .select("row", u.alias("u"), "low", "steps")
             .select("row", times.alias("times"))
             .filter("times > 0")
             .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times").cast("long"))).alias("copy")))
    key = F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")),
                            F.col("copy")))
    return (drawn.withColumn("shuffle_key", F.substring(key, 1, 16))
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key", "copy")
            .select("row.*", "copy", "shuffle_key"))


def square_root_weights(docs: DataFrame) -> DataFrame:
    """(source, weight): each source's share to the power one half, the usual
    flattening of a skewed mixture."""
    return docs.groupBy("source").agg(F.sqrt(F.count("*").cast("double")).alias("weight"))
