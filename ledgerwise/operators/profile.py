"""Exploratory statistics: the data behind each chart, computed in Spark.

Nothing here collects rows: ranges, counts, co-moments and order statistics
are summed where the rows are (``blockwise``); only numbers per group and feature
reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.columns import no_nan
from . import blockwise
from .aggregates import top_k, with_share


def class_distribution(df: DataFrame, label: str = S.LABEL_COL) -> DataFrame:
    """Count and percentage per class (bar and pie data), keyed by class."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return with_share(g, "count", "pct", 4)


# --- histogram ------------------------------------------------------------------

def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50, by: str | None = S.LABEL_COL) -> DataFrame:
    """Equal-width histogram per column (and per ``by`` group), range taken
    per group as numpy does: ``[min, max]``, or ``min ± 0.5`` when all values
    are equal. A value is in bin ``i`` when ``edge_i <= x < edge_{i+1}``, the
    maximum in the last bin. Null and NaN are skipped. Every bin is returned,
    empty ones with count 0. Two scans whatever the number of columns: the ranges,
    and the counts against the edges, summed in each task. At most
    ``blockwise.MAX_GROUPS`` groups (their edges are held by the driver).
    """
    spark, keep, cols = df.sparkSession, [by] if by else [], list(cols)
    val = {c: no_nan(F.col(c).cast("double")) for c in cols}
    # ranges of all columns in one aggregate; one row per group
    ends = df.groupBy(*keep).agg(*[f(val[c]).alias(f"_{n}{i}") for i, c in enumerate(cols) for n, f in (("mn", F.min), ("mx", F.max))])
    edges = {}
    for r in ends.limit(blockwise.MAX_GROUPS + 1).collect():
        for i in range(len(cols)):
            lo, hi = r[f"_mn{i}"], r[f"_mx{i}"]
            if lo is not None:
                lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
                edges[r[by] if by else 0, i] = np.append(np.arange(bins) * ((hi - lo) / bins) + lo, hi)
    if not edges:
        raise ValueError("histogram needs a column with a value")
    if len({g for g, _ in edges}) > blockwise.MAX_GROUPS:
        raise ValueError(f"more than {blockwise.MAX_GROUPS} groups of {by}")
    counts = blockwise.counts_at(df, cols, edges, by)
    rows = []
    for (g, i), e in edges.items():
        n = counts[g, i]
        inside = n[1:-2:2] + n[2:-1:2]   # on the lower edge, and between it and the next
        inside[-1] += n[-2]              # the maximum
        rows += [(*([g] if by else []), cols[i], b + 1, float(e[b]), float(e[b + 1]), int(inside[b])) for b in range(bins)]
    by_fields = [T.StructField(by, df.schema[by].dataType)] if by else []
    return spark.createDataFrame(rows, T.StructType([*by_fields, T.StructField("feature", T.StringType()), T.StructField("bin", T.IntegerType()),
                                                     T.StructField("bin_lo", T.DoubleType()), T.StructField("bin_hi", T.DoubleType()),
                                                     T.StructField("count", T.LongType())]))


# --- correlation -----------------------------------------------------------------

def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson ``(x, y, r)`` for each column pair, over the rows where both
    are present (not null, not NaN), as pandas pairs them; null when either
    side is constant (no division by zero). One scan for any number of columns
    and pairs, by co-moments merged from block to block (``blockwise``).
    """
    pairs = list(dict.fromkeys(pairs))
    names = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(names)}
    return blockwise.correlations(df, names, [(at[a], at[b]) for a, b in pairs])


def label_correlation(df: DataFrame, cols: Sequence[str] = S.V_COLS + ["Amount"],
                      label: str = S.LABEL_COL, digits: int | None = None) -> DataFrame:
    """``(feature, corr)`` of each column with the label."""
    out = pair_correlations(df, [(c, label) for c in cols]).select(
        F.col("x").alias("feature"), F.col("r").alias("corr"))
    if digits is not None:
        out = out.withColumn("corr", F.round("corr", digits))
    return out


def top_correlated(df: DataFrame, k: int = 10, cols: Sequence[str] = S.V_COLS + ["Amount"],
                   label: str = S.LABEL_COL, digits: int | None = None) -> DataFrame:
    """Top ``k`` columns by absolute correlation with the label."""
    lc = label_correlation(df, cols, label).withColumn("abs_corr", F.abs("corr"))
    top = top_k(lc, k, "abs_corr", ties=["feature"])
    if digits is not None:
        top = top.select("feature", F.round("corr", digits).alias("corr"),
                         F.round("abs_corr", digits).alias("abs_corr"))
    return top


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Long ``(x, y, r)`` matrix over ``cols`` (both triangles and the diagonal)."""
    cols = list(cols)
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    half = pair_correlations(df, upper)
    both = F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("r")))
    out = half.select(F.inline(F.slice(both, 1, F.when(F.col("x") == F.col("y"), 1).otherwise(2))))
    if digits is not None:
        out = out.withColumn("r", F.round("r", digits))
    return out


# --- box statistics ---------------------------------------------------------------

def _interpolated(at, n: int, p: float) -> float:
    """The quantile ``p`` of ``n`` rows; ``at(position)`` is the value at a 1-based position."""
    h = (n - 1) * p
    lo = int(h)
    a, b, t = at(lo + 1), at(min(lo + 2, n)), h - lo
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)


QUARTILES = (0.25, 0.5, 0.75)


def _quartile_positions(n: int) -> list[int]:
    return [q for p in QUARTILES for q in (int((n - 1) * p) + 1, min(int((n - 1) * p) + 2, n))]


def box_stats(df: DataFrame, cols: Sequence[str], by: str = S.LABEL_COL, whisker: float = 1.5, approximate: bool = False) -> DataFrame:
    """Quartiles (linear interpolation), whiskers at the most extreme values
    within ``whisker * IQR`` and the outlier count, per column and group (the
    group of rows without a value in ``by`` included).

    Quartiles are exact order statistics of all columns and groups, searched together
    (``blockwise.order_statistics``); with ``approximate`` they are read off mergeable
    sketches in one scan. Whiskers and outliers are one more aggregate in which each row is
    compared with its group's fences; rows are not expanded.
    """
    spark, cols = df.sparkSession, list(cols)
    quart: dict = {}
    if approximate:
        for r in blockwise.sketch_quantiles(df, cols, QUARTILES, by).collect():
            if r["n"]:
                quart[r[by], cols.index(r["feature"])] = (r["n"], *r["quantiles"])
    else:
        sizes, found = blockwise.order_statistics(df, cols, _quartile_positions, by)
        for (g, j), n in sizes.items():
            quart[g, j] = (n, *[_interpolated(lambda q, g=g, j=j: found[g, j, q], n, p) for p in QUARTILES])
    rows = [(g, cols[j], n, q1, q2, q3, q3 - q1, q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)) for (g, j), (n, q1, q2, q3) in quart.items()]
    by_type = df.schema[by].dataType
    double = [T.StructField(c, T.DoubleType()) for c in ("q1", "median", "q3", "iqr", "_low", "_high")]
    q = spark.createDataFrame(rows, T.StructType([T.StructField(by, by_type), T.StructField("feature", T.StringType()), T.StructField("n", T.LongType()), *double]))
    # one row per group: the fences of all its columns side by side
    fences = q.groupBy(by).agg(*[F.max(F.when(F.col("feature") == c, F.col(f))).alias(f"_{f}{i}") for i, c in enumerate(cols) for f in ("_low", "_high")]) \
        .withColumnRenamed(by, "_by")
    v = [no_nan(F.col(c).cast("double")) for c in cols]
    x = df.select(F.col(by).alias("_g"), *[c.alias(f"_v{i}") for i, c in enumerate(v)])
    aggs = []
    for i in range(len(cols)):
        c, lo, hi = F.col(f"_v{i}"), F.col(f"__low{i}"), F.col(f"__high{i}")
        aggs.append(F.struct(F.min(F.when(c >= lo, c)).alias("whisker_lo"), F.max(F.when(c <= hi, c)).alias("whisker_hi"),
                             F.count_if((c < lo) | (c > hi)).alias("outliers"), F.min(c).alias("min"), F.max(c).alias("max")).alias(f"_a{i}"))
    # at most MAX_GROUPS rows, all of them known to the driver
    each = x.join(F.broadcast(fences), F.col("_g").eqNullSafe(F.col("_by"))).groupBy("_g").agg(*aggs)
    wide = F.array(*[F.struct(F.lit(c).alias("_f"), F.col(f"_a{i}").alias("a")) for i, c in enumerate(cols)])
    long = each.select("_g", F.inline(wide))
    return q.join(long, q[by].eqNullSafe(F.col("_g")) & (F.col("feature") == F.col("_f"))).select(
        "feature", by, "n", "q1", "median", "q3", "iqr", "a.whisker_lo", "a.whisker_hi", "a.outliers", "a.min", "a.max")
