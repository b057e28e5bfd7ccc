"""Schemas, column lists and fixed labels of the transaction data model.

The names, thresholds and labels in this module are fixed values: they must
equal the ones the pipeline's consumers (gold tables, reports, model
features) expect.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# PCA-style feature columns of the raw file: V1 .. V28
V_COLS = [f"V{i}" for i in range(1, 29)]
ID_COL = "id"
AMOUNT_COL = "Amount"
LABEL_COL = "Class"
RAW_COLS = [ID_COL] + V_COLS + [AMOUNT_COL, LABEL_COL]

# Amount bins, left-closed: < 50 Low, < 200 Medium, < 1000 High, else Very_High
AMOUNT_EDGES = [50.0, 200.0, 1000.0]
AMOUNT_LABELS = ["Low", "Medium", "High", "Very_High"]

# Risk bands on the fraud probability, right-closed:
# (-0.001, 0.3] Low, (0.3, 0.7] Medium, (0.7, 1.001] High
RISK_EDGES = [-0.001, 0.3, 0.7, 1.001]
RISK_LABELS = ["Low", "Medium", "High"]

# Columns that get an absolute-value copy
ABS_COLS = ["V1", "V2", "V3", "V4", "V5"]

# The 37 model features, in order
MODEL_FEATURES = V_COLS + [
    "Amount_log", "Amount_percentile",
    "V1_abs", "V2_abs", "V3_abs", "V4_abs", "V5_abs",
    "V1_V2_interaction", "V1_Amount_interaction",
]

# Columns averaged per class in the feature summary
SUMMARY_COLS = V_COLS + ["Amount", "Amount_log"]

# Provenance columns of bronze, dropped at silver
PROVENANCE_COLS = ["ingestion_timestamp", "data_source", "source_endpoint"]

# Table names
BRONZE = "bronze_transactions"
SILVER = "silver_transactions"
GOLD_BY_AMOUNT = "gold_fraud_by_amount"
GOLD_BY_QUARTILE = "gold_fraud_by_quartile"
GOLD_KPIS = "gold_kpis"
GOLD_FEATURE_SUMMARY = "gold_feature_summary"
GOLD_SCORES = "gold_fraud_scores"
GOLD_PERFORMANCE = "gold_model_performance"
RUNS = "experiment_runs"
REGISTRY = "model_registry"
ROC = "roc_points"
MODEL_NAME = "fraud-detection-model"
EXPERIMENT_NAME = "fraud-detection-experiment"
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [T.StructField(ID_COL, T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in V_COLS]
    + [T.StructField(AMOUNT_COL, T.DoubleType()), T.StructField(LABEL_COL, T.IntegerType())]
)

# Target types of the silver cast
SILVER_TYPES: dict[str, T.DataType] = {
    **{c: T.DoubleType() for c in V_COLS},
    AMOUNT_COL: T.DoubleType(),
    LABEL_COL: T.IntegerType(),
    ID_COL: T.IntegerType(),
}

SCORES_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("Amount", T.DoubleType()),
    T.StructField("Class", T.IntegerType()),
    T.StructField("fraud_prediction", T.LongType()),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("risk_category", T.StringType()),
    T.StructField("scored_at", T.TimestampType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
])

PERFORMANCE_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("auc_roc", T.DoubleType()),
    T.StructField("total_scored", T.LongType()),
    T.StructField("total_flagged", T.LongType()),
    T.StructField("scored_at", T.TimestampType()),
])

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_path", T.StringType()),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("registered_at", T.TimestampType()),
])
