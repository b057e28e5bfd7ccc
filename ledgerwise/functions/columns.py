"""Column expressions: all built-in, JVM-side, inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log1p(c: str | Column) -> Column:
    """ln(1 + x): null at x <= -1, NaN stays NaN, 0 at 0."""
    return F.log1p(col_(c))


def left_closed_bins(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``x < e1 -> l1, x < e2 -> l2, ..., else last``; null and NaN fall to the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = col_(c)
    expr = F.when(x < F.lit(edges[0]), F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        expr = expr.when(x < F.lit(e), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def right_closed_bins(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``(e0, e1] -> l1, (e1, e2] -> l2, ...``; outside the edges, null or NaN -> null.

    NaN compares greater than every number in Spark, so the upper bound of
    the last bin keeps it out.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label fewer than edges")
    x = col_(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def abs_(c: str | Column) -> Column:
    return F.abs(col_(c))


def interaction(a: str | Column, b: str | Column) -> Column:
    return col_(a) * col_(b)


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (null conditions count 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def rate_pct(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``round(num * 100.0 / den, digits)`` as double; null when den is 0."""
    return F.round(F.try_divide(numerator.cast("double") * F.lit(100.0), denominator), digits)


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, plus NaN for float/double columns."""
    dt = df.schema[c].dataType
    cond = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(F.col(c))
    return cond


def no_nan(c: str | Column) -> Column:
    """NaN -> null, so that aggregates skip it as pandas does."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))
