"""Z-score scaling with the population standard deviation.

Fitting is one aggregate (mean and ``stddev_pop`` per feature); the fitted
scaler is a ``SQLTransformer`` stage holding the constants, so it is saved
and loaded with the rest of the model pipeline. A constant feature is
divided by 1 (it scores 0), never by 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        out[c] = (0.0 if m is None else float(m), 1.0 if (s is None or s == 0.0) else float(s))
    return out


def _lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def scaler_stage(stats: dict[str, tuple[float, float]], suffix: str = "_z") -> SQLTransformer:
    exprs = ", ".join(f"(`{c}` - {_lit(m)}) / {_lit(s)} AS `{c}{suffix}`" for c, (m, s) in stats.items())
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def fit_scaler(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> SQLTransformer:
    return scaler_stage(fit_scaler_stats(df, cols), suffix)


def zscore(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Fit on ``df`` and scale it (the 'refit' mode): returns the scaled columns."""
    stats = fit_scaler_stats(df, cols)
    out = [F.col(c) for c in df.columns if c not in cols]
    for c, (m, s) in stats.items():
        z = (F.col(c) - F.lit(m)) / F.lit(s)
        out.append((F.round(z, digits) if digits is not None else z).alias(c))
    return df.select(*out)
