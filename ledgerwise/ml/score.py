"""Batch scoring of every row and the model-performance summary."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import right_closed_bins
from ..operators import metrics as M
from .scale import fit_scaler


def score_rows(model: PipelineModel, df: DataFrame, model_name: str, model_version: str,
               scaler: str = "saved", stamp: bool = True, partitions: int | None = None) -> DataFrame:
    """Scores in the ``gold_fraud_scores`` shape, one plan from scan to rows.

    ``scaler="saved"`` uses the scaler fitted on the training side (stage 0
    of the pipeline); ``"refit"`` fits it again on the scored rows.
    """
    stages = list(model.stages)
    if scaler == "refit":
        feats = list(stages[1].getInputCols())
        stages[0] = fit_scaler(df, [c[:-2] for c in feats])
    m = PipelineModel(stages)
    # CPU-bound per row (hundreds of trees): ``partitions`` spreads a small table
    out = m.transform(df.repartition(partitions) if partitions else df)
    from pyspark.ml.functions import vector_to_array
    p = F.bround(vector_to_array("probability")[1], 6)
    res = out.select(
        F.col("id").cast("int").alias("id"), F.col("Amount").cast("double").alias("Amount"),
        F.col("Class").cast("int").alias("Class"),
        F.col("prediction").cast("long").alias("fraud_prediction"),
        p.alias("fraud_probability"))
    res = res.withColumn("risk_category", right_closed_bins("fraud_probability", S.RISK_EDGES, S.RISK_LABELS))
    if stamp:
        res = res.withColumn("scored_at", F.current_timestamp())
    return res.withColumn("model_name", F.lit(model_name)).withColumn("model_version", F.lit(str(model_version)))


def model_performance(scores: DataFrame, model_name: str, model_version: int,
                      digits: int = 4, stamp: bool = True) -> DataFrame:
    """One row of metrics over the whole scored table, plus totals."""
    m = M.classification_metrics(scores, "Class", "fraud_prediction")
    auc = M.auc_roc(scores, "Class", "fraud_probability")
    tot = scores.agg(F.count(F.lit(1)).alias("total_scored"),
                     F.coalesce(F.sum("fraud_prediction"), F.lit(0)).cast("long").alias("total_flagged"))
    # three one-row aggregates side by side (zip of one-row frames, no cross product)
    row = {**m.first().asDict(), **auc.first().asDict(), **tot.first().asDict()}
    spark = scores.sparkSession
    data = [(model_name, int(model_version),
             *[None if row[k] is None else round(float(row[k]), digits)
               for k in ("accuracy", "precision", "recall", "f1_score", "auc_roc")],
             int(row["total_scored"]), int(row["total_flagged"]))]
    df = spark.createDataFrame(data, "model_name string, model_version long, accuracy double, "
                                     "precision double, recall double, f1_score double, auc_roc double, "
                                     "total_scored long, total_flagged long")
    return df.withColumn("scored_at", F.current_timestamp()) if stamp else df


def prediction_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("fraud_prediction").agg(F.count(F.lit(1)).alias("count"))


def risk_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_category").agg(F.count(F.lit(1)).alias("count"))
