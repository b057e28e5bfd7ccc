"""Typed read-only reporting views over the gold tables, and the page queries.

The view types follow the reporting model: whole numbers as ``bigint``,
measures as ``double``, labels as ``string``, stamps as ``timestamp``.
Default summarization: numeric columns are summed, strings and stamps are
grouping columns; rates and ids are never summed unless asked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S

# Column types of each view (fixed values of the reporting model)
VIEW_TYPES: dict[str, dict[str, str]] = {
    S.GOLD_BY_AMOUNT: {"Amount_category": "string", "total_transactions": "bigint",
                       "fraud_count": "bigint", "legit_count": "bigint",
                       "avg_amount": "double", "fraud_rate_pct": "double"},
    S.GOLD_BY_QUARTILE: {"Amount_quartile": "bigint", "total_transactions": "bigint",
                         "fraud_count": "bigint", "avg_amount": "double", "fraud_rate_pct": "double"},
    S.GOLD_KPIS: {"total_transactions": "bigint", "total_frauds": "bigint", "total_legit": "bigint",
                  "overall_fraud_rate": "double", "total_fraud_amount": "double",
                  "avg_transaction_amount": "double", "report_generated_at": "timestamp"},
    S.GOLD_SCORES: {"id": "bigint", "Amount": "double", "Class": "bigint", "fraud_prediction": "bigint",
                    "fraud_probability": "double", "risk_category": "string", "scored_at": "timestamp",
                    "model_name": "string", "model_version": "string"},
    S.GOLD_PERFORMANCE: {"model_name": "string", "model_version": "bigint", "accuracy": "double",
                         "precision": "double", "recall": "double", "f1_score": "double",
                         "auc_roc": "double", "total_scored": "bigint", "total_flagged": "bigint",
                         "scored_at": "timestamp"},
}

OPTIONAL = {"report_generated_at", "scored_at"}

# Columns never summed by default (rates, averages, ids, labels)
NOT_SUMMED = {"avg_amount", "fraud_rate_pct", "overall_fraud_rate", "avg_transaction_amount",
              "id", "Class", "Amount_quartile", "fraud_probability", "model_version",
              "accuracy", "precision", "recall", "f1_score", "auc_roc"}


def typed_view(df: DataFrame, name: str) -> DataFrame:
    """The view's columns in their types. A missing column raises, but for the
    stamps and model names in ``OPTIONAL``, which unstamped frames do without."""
    types = VIEW_TYPES[name]
    missing = [c for c in types if c not in df.columns and c not in OPTIONAL]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items() if c in df.columns])


def publish_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Register each gold table as a typed temp view under its own name."""
    out = {}
    for name, df in tables.items():
        if name in VIEW_TYPES:
            v = typed_view(df, name)
            v.createOrReplaceTempView(name)
            out[name] = v
    return out


def report_aggregate(view: DataFrame, dims: Sequence[str] = (), measures: Sequence[str] | None = None) -> DataFrame:
    """Group by ``dims`` and sum the numeric measures (default: every numeric
    column that is not a rate, average, id or label)."""
    numeric = {"bigint", "int", "double", "float", "smallint", "tinyint"}
    if measures is None:
        measures = [f.name for f in view.schema.fields
                    if f.dataType.simpleString() in numeric and f.name not in NOT_SUMMED
                    and f.name not in dims]
    aggs = [F.sum(m).alias(f"sum_{m}") for m in measures]
    return view.groupBy(*dims).agg(*aggs) if dims else view.agg(*aggs)


def executive_summary(kpis: DataFrame) -> DataFrame:
    return kpis.select("total_transactions", "total_frauds", "total_legit",
                       "overall_fraud_rate", "total_fraud_amount", "avg_transaction_amount")


def fraud_analysis(by_amount: DataFrame, by_quartile: DataFrame) -> DataFrame:
    """Rate by amount category and by quartile in one long table."""
    a = by_amount.select(F.lit("amount_category").alias("dimension"),
                         F.col("Amount_category").cast("string").alias("bucket"),
                         "total_transactions", "fraud_count", "fraud_rate_pct")
    q = by_quartile.select(F.lit("amount_quartile").alias("dimension"),
                           F.col("Amount_quartile").cast("string").alias("bucket"),
                           "total_transactions", "fraud_count", "fraud_rate_pct")
    return a.unionByName(q)


def roc_by_model(curves: dict[str, DataFrame]) -> DataFrame:
    """The ROC points of each model in one table."""
    out = None
    for model, points in curves.items():
        part = points.select(F.lit(model).alias("model"), "threshold", "fpr", "tpr")
        out = part if out is None else out.unionByName(part)
    return out


def performance_page(perf: DataFrame) -> DataFrame:
    return perf.select("model_name", "model_version", "auc_roc", "precision", "recall", "f1_score")


def scores_page(scores: DataFrame, risk: str | None = None) -> DataFrame:
    """Scored rows, optionally one risk band (a filter pushed to the scan)."""
    return scores if risk is None else scores.filter(F.col("risk_category") == F.lit(risk))
