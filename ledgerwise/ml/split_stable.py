"""A split that stays put: the side of a row depends on nothing but its own unit.

A unit's hash as a share of its range is compared with a fixed threshold per class, so
no row changes sides when others come or go, and any job at any time gives the same answer
for it, without a pass over the data. A unit is the row's id, or a group (a customer, a day)
that must stay on one side whole. The price is the exact size: the test side's share
lies within binomial bounds of the threshold.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

HASH_RANGE = 4294967296.0   # of the first 32 bits of an MD5


def unit_share(unit: str | Column, seed: int = 42) -> Column:
    """A number in [0, 1) from the MD5 of ``seed:unit``; a null unit is an empty string."""
    u = F.col(unit) if isinstance(unit, str) else unit
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(u.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(HASH_RANGE)


def stable_split(df: DataFrame, test_frac: float | Mapping[object, float] = 0.2, seed: int = 42, label: str = S.LABEL_COL,
                 id_col: str = S.ID_COL, group: str | None = None, out: str = "split") -> DataFrame:
    """Adds ``out`` = 'test' / 'train', a projection. ``test_frac`` is one threshold or one for each
    class (classes not named: all train); with ``group`` whole groups stay together, so that one
    threshold must do for all classes."""
    if isinstance(test_frac, Mapping):
        if group is not None:
            raise ValueError("a group may hold several classes: give one threshold")
        limit = F.lit(0.0)
        for k, f in test_frac.items():
            limit = F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(float(f))).otherwise(limit)
    else:
        limit = F.lit(float(test_frac))
    return df.withColumn(out, F.when(unit_share(group or id_col, seed) < limit, F.lit("test")).otherwise(F.lit("train")))
