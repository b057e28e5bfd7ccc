"""Dedup and data-quality gates.

Every audit is one global aggregate (partial aggregation on the map side,
a single row to the driver at most).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, is_missing


class QualityGateError(AssertionError):
    """Raised when a quality rule fails; ``failures`` lists the broken rules."""

    def __init__(self, failures: list[str]):
        super().__init__("; ".join(failures))
        self.failures = failures


def null_counts(df: DataFrame) -> DataFrame:
    """Per column, rows that are null (or NaN for float/double), one pass."""
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Total rows, distinct keys, and the surplus.

    The key tuple is counted as a struct, which is never null, so a null key
    is one distinct value, as ``select(keys).distinct().count()`` has it.
    """
    k = F.struct(*[F.col(c) for c in keys])
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_distinct(k).alias("distinct_ids")) \
        .withColumn("duplicates", F.col("total_records") - F.col("distinct_ids"))


def dedupe(df: DataFrame, keys: Sequence[str] = ("id",), deterministic: bool = True) -> DataFrame:
    """One row per key.

    Deterministic (default): the smallest row by the remaining columns in
    column order (nulls first, NaN last), as ``row_number() = 1`` over
    ``ORDER BY <all columns>`` would pick, but planned as an aggregate:
    ``min(struct(...))`` is combined on the map side, so a key that holds a
    large share of the rows shrinks to one row per map task before the
    shuffle instead of landing whole in one window task.

    ``deterministic=False`` is ``dropDuplicates`` (an arbitrary row).
    """
    keys = list(keys)
    if not deterministic:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_row"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def quality_checks(id_col: str = "id", amount: str = "Amount", label: str = "Class", unique: bool = False) -> list[Column]:
    """The nine checks (total, unique ids, null labels, negative amounts, min/max/avg
    amount, fraud and legit counts) as aggregates. ``unique``: the ids are known to be
    distinct, so that counting those present will do, without a shuffle."""
    a, y = F.col(amount), F.col(label)
    ids = F.count(F.col(id_col)) if unique else F.count_distinct(F.col(id_col))
    return [
        F.count(F.lit(1)).alias("total_records"),
        ids.alias("unique_ids"),
        F.sum(flag(y.isNull())).cast("long").alias("null_labels"),
        F.sum(flag(a < F.lit(0))).cast("long").alias("negative_amounts"),
        F.min(a).alias("min_amount"),
        F.max(a).alias("max_amount"),
        F.round(F.avg(a), 2).alias("avg_amount"),
        F.sum(flag(y == F.lit(1))).cast("long").alias("fraud_count"),
        F.sum(flag(y == F.lit(0))).cast("long").alias("legit_count"),
    ]


def quality_summary(df: DataFrame, id_col: str = "id", amount: str = "Amount",
                    label: str = "Class") -> DataFrame:
    """``quality_checks`` of a table, in one row."""
    return df.agg(*quality_checks(id_col, amount, label))


def assert_quality(summary: DataFrame | dict) -> dict:
    """Fail on null labels, negative amounts or duplicate ids.

    Takes the one-row summary (only that row reaches the driver). On an
    empty table the sums are null and every rule fails.
    """
    row = summary if isinstance(summary, dict) else summary.first().asDict()
    failures = []
    if row.get("null_labels") != 0:
        failures.append(f"null labels: {row.get('null_labels')}")
    if row.get("negative_amounts") != 0:
        failures.append(f"negative amounts: {row.get('negative_amounts')}")
    if not row.get("total_records"):
        failures.append("empty table")
    elif row.get("total_records") != row.get("unique_ids"):
        failures.append(f"duplicate ids: {row.get('total_records')} rows, {row.get('unique_ids')} ids")
    if failures:
        raise QualityGateError(failures)
    return row
