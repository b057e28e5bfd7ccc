"""Gold aggregates, value counts, top-k and best-row selection.

All are grouped or global aggregates with map-side partial aggregation;
grouping keys are low-cardinality (category, quartile, class), so the
shuffle carries one row per key per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import flag, rate_pct


def _fraud(label: str = S.LABEL_COL) -> Column:
    return flag(F.col(label) == F.lit(1))


def _legit(label: str = S.LABEL_COL) -> Column:
    return flag(F.col(label) == F.lit(0))


def class_balance(df: DataFrame, label: str = S.LABEL_COL) -> DataFrame:
    """Total, fraud, legit and fraud percentage (rounded 4)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(_fraud(label)).cast("long").alias("fraud_count"),
        F.sum(_legit(label)).cast("long").alias("legit_count"),
        rate_pct(F.sum(_fraud(label)), F.count(F.lit(1))).alias("fraud_pct"),
    )


def fraud_by(df: DataFrame, key: str, with_legit: bool = True, amount: str = S.AMOUNT_COL,
             label: str = S.LABEL_COL) -> DataFrame:
    """Per ``key``: total, fraud (and legit) counts, average amount (round 2),
    fraud rate % (round 4). A null label is in the total and the rate's
    denominator but in neither count."""
    aggs = [F.count(F.lit(1)).alias("total_transactions"),
            F.sum(_fraud(label)).cast("long").alias("fraud_count")]
    if with_legit:
        aggs.append(F.sum(_legit(label)).cast("long").alias("legit_count"))
    aggs += [F.round(F.avg(amount), 2).alias("avg_amount"),
             rate_pct(F.sum(_fraud(label)), F.count(F.lit(1))).alias("fraud_rate_pct")]
    return df.groupBy(key).agg(*aggs)


def fraud_by_amount(df: DataFrame) -> DataFrame:
    return fraud_by(df, "Amount_category", with_legit=True)


def fraud_by_quartile(df: DataFrame) -> DataFrame:
    return fraud_by(df, "Amount_quartile", with_legit=False).orderBy("Amount_quartile")


def kpis(df: DataFrame, amount: str = S.AMOUNT_COL, label: str = S.LABEL_COL,
         stamp: bool = True) -> DataFrame:
    """One KPI row; fraud amount sums ``Amount`` over fraud rows (round 2)."""
    out = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(_fraud(label)).cast("long").alias("total_frauds"),
        F.sum(_legit(label)).cast("long").alias("total_legit"),
        rate_pct(F.sum(_fraud(label)), F.count(F.lit(1))).alias("overall_fraud_rate"),
        F.round(F.sum(F.when(F.col(label) == F.lit(1), F.col(amount)).otherwise(F.lit(0.0))), 2)
        .alias("total_fraud_amount"),
        F.round(F.avg(amount), 2).alias("avg_transaction_amount"),
    )
    return out.withColumn("report_generated_at", F.current_timestamp()) if stamp else out


def feature_summary(df: DataFrame, cols: Sequence[str] = S.SUMMARY_COLS,
                    label: str = S.LABEL_COL, digits: int = 4) -> DataFrame:
    """Average of each column per class, rounded."""
    return df.groupBy(label).agg(*[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency per value, most frequent first (value breaks ties)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first())


def label_rate_pct(df: DataFrame, label: str = S.LABEL_COL, digits: int = 4) -> DataFrame:
    """Mean of the 0/1 label times 100."""
    return df.agg(F.round(F.avg(label) * F.lit(100.0), digits).alias("fraud_pct"))


def top_k(df: DataFrame, k: int, by: str | Column, ties: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` rows by ``by`` descending (TakeOrderedAndProject: each task
    keeps ``k`` rows, never a full sort)."""
    b = F.col(by) if isinstance(by, str) else by
    return df.orderBy(b.desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)


def best_row(df: DataFrame, metric: str, started: str = "started_at", tiebreak: str = "run_id") -> DataFrame:
    """The row with the highest ``metric`` (nulls last); a tie goes to the
    later start, then to the smaller id."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(started).desc_nulls_last(),
                      F.col(tiebreak).asc()).limit(1)


def with_share(grouped: DataFrame, count_col: str = "count", out: str = "pct",
               digits: int = 4) -> DataFrame:
    """Share of each group in the total. ``grouped`` is already aggregated
    (one row per group), so the empty-partition window sees only a handful of
    rows."""
    total = F.sum(count_col).over(Window.partitionBy())
    return grouped.withColumn(out, F.round(F.col(count_col) * F.lit(100.0) / total, digits))
