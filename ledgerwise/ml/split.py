"""Exact stratified train/test split without a global sort.

Each row gets ``h = xxhash64(id, seed)``. Per class, the test side is the
``round(frac * n_class)`` rows with the smallest ``(h, id)``. The border row
of each class is an exact order statistic (see ``operators.ranks``), so the
split is a projection against a table of one border per class: no sort,
no dependence on partitioning, exact class sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ranks


def _test_size(n: int, frac: float) -> int:
    return int(math.floor(frac * n + 0.5))


MAX_CLASSES = 10_000


def _id_at(rows: DataFrame, id_col: str, place: int):
    """The id at a 1-based place of the ascending order (null first): an order statistic, not a list."""
    n_null = rows.filter(F.col(id_col).isNull()).count()
    if place <= n_null:
        idv, last = None, n_null
    else:
        idv, before, ties = ranks.order_statistics(rows, id_col, {(): [place - n_null]})[((), place - n_null)]
        last = n_null + before + ties
    if last != place:
        raise ValueError(f"several rows have {id_col}={idv!r} at the border of the split; ids must be unique")
    return idv


def stratified_split(df: DataFrame, test_frac: float = 0.2, seed: int = 42,
                     label: str = "Class", id_col: str = "id", out: str = "split",
                     key: Column | None = None) -> DataFrame:
    """Adds ``out`` = 'test' / 'train'. ``key`` replaces the hash of the id as the
    order the test side is taken from. A border between rows of one (key, id)
    raises: such rows can't be told apart."""
    h = F.xxhash64(F.col(id_col), F.lit(seed)) if key is None else key
    x = df.withColumn("_h", h)
    sizes = {(r[label],): r["n"] for r in x.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()}
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    wanted = {k: [_test_size(n, test_frac)] for k, n in sizes.items() if _test_size(n, test_frac) >= 1}
    stats = ranks.order_statistics(x, "_h", wanted, group_cols=[label], group_sizes=sizes)
    borders = []
    for k, (t,) in wanted.items():
        hv, before, ties = stats[(k, t)]
        left = t - before
        if left < ties:  # the border runs between ids of one hash (of very many, if ``key`` has few values)
            same = x.filter(F.col(label).eqNullSafe(F.lit(k[0])) & (F.col("_h") == F.lit(hv))).select(id_col)
            idv = _id_at(same, id_col, left)
            borders.append((k[0], hv, False, idv))
        else:
            borders.append((k[0], hv, True, None))
    schema = T.StructType([T.StructField("_label", df.schema[label].dataType), T.StructField("_bh", x.schema["_h"].dataType),
                           T.StructField("_all", T.BooleanType()), T.StructField("_bi", df.schema[id_col].dataType)])
    # one row per class, all of them known to the driver
    x = x.join(F.broadcast(df.sparkSession.createDataFrame(borders, schema)), F.col(label).eqNullSafe(F.col("_label")), "left")
    low_id = F.struct(F.col(id_col).alias("i")) <= F.struct(F.col("_bi").alias("i"))
    test = (F.col("_h") < F.col("_bh")) | ((F.col("_h") == F.col("_bh")) & (F.col("_all") | low_id))
    return x.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train"))).select(*df.columns, out)


def split_report(df: DataFrame, label: str = "Class", split: str = "split") -> DataFrame:
    """Size and fraud rate of both sides, one grouped aggregate."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("fraud_count"),
        F.round(F.avg(label) * F.lit(100.0), 4).alias("fraud_rate_pct"))
