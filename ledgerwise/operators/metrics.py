"""Classification metrics as DataFrame aggregates.

Threshold metrics come from one pass of four conditional counts. Ranking
metrics (AUC, average precision, ROC points) group rows by score (positives
and negatives per distinct score) and take running sums over that table,
range-partitioned by score, so they are exact with ties and never sort all
rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag
from . import ranks


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.filter(y.isNotNull()).agg(
        F.sum(flag((y == 1) & (p == 1))).cast("long").alias("tp"),
        F.sum(flag((y == 0) & (p == 1))).cast("long").alias("fp"),
        F.sum(flag((y == 1) & (p != 1))).cast("long").alias("fn"),
        F.sum(flag((y == 0) & (p != 1))).cast("long").alias("tn"),
    )


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (nothing predicted / nothing actual)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "Class", pred: str = "prediction") -> DataFrame:
    """Fixed 2x2 grid ``(actual, predicted, count)``, zero cells included."""
    c = _counts(df, label, pred)
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                               F.coalesce(F.col(n), F.lit(0)).alias("count"))
                      for a, p, n in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]])
    return c.select(F.inline(cells))


def classification_metrics(df: DataFrame, label: str = "Class", pred: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 (0 where undefined) and the four counts."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.coalesce(F.col(x), F.lit(0)) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))


def score_table(df: DataFrame, label: str = "Class", score: str = "score", with_prev: bool = False) -> DataFrame:
    """Per distinct score: positives, negatives, and how many of each have a
    smaller score (``_before_pos``, ``_before_neg``)."""
    y = F.col(label)
    rows = df.filter(y.isNotNull() & F.col(score).isNotNull())
    g = (rows.groupBy(score).agg(F.sum(flag(y == 1)).cast("long").alias("pos"),
                             F.sum(flag(y != 1)).cast("long").alias("neg")))
    return (ranks.prefix_sums(g, score, ["pos", "neg"], with_prev=with_prev, with_totals=True)
            .withColumnRenamed("_total_pos", "P").withColumnRenamed("_total_neg", "N"))


def auc_roc(df: DataFrame, label: str = "Class", score: str = "score") -> DataFrame:
    """Exact ROC AUC (Mann-Whitney: a tied positive/negative pair counts 1/2);
    null when only one class is present."""
    return auc_of(score_table(df, label, score))


def auc_of(st: DataFrame) -> DataFrame:
    part = st.agg(F.sum(F.col("pos") * (F.col("_before_neg") + F.col("neg") * 0.5)).alias("_u"),
                  F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return part.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                              F.col("_u") / (F.col("P").cast("double") * F.col("N"))).alias("auc_roc"))


def average_precision(df: DataFrame, label: str = "Class", score: str = "score") -> DataFrame:
    """Sum over thresholds of (recall step) x precision, no interpolation."""
    return average_precision_of(score_table(df, label, score))


def average_precision_of(st: DataFrame) -> DataFrame:
    tp = F.col("P") - F.col("_before_pos")
    fp = F.col("N") - F.col("_before_neg")
    return st.agg(F.sum(F.when(F.col("pos") > 0, F.col("pos") * tp / (tp + fp))).alias("_s"),
                 F.first("P").alias("P")) \
        .select(F.when(F.col("P") > 0, F.coalesce(F.col("_s"), F.lit(0.0)) / F.col("P")).alias("average_precision"))


def roc_points(df: DataFrame, label: str = "Class", score: str = "score",
               drop_intermediate: bool = True) -> DataFrame:
    """ROC curve ``(threshold, fpr, tpr)``, from (0, 0) at threshold +inf down
    through every distinct score. ``drop_intermediate`` removes points in the
    middle of a straight run (the next lower score adds the same numbers of
    positives and negatives as this one)."""
    st = score_table(df, label, score, with_prev=True)
    x = st
    tp = F.col("P") - F.col("_before_pos")
    fp = F.col("N") - F.col("_before_neg")
    pts = x.select(F.col(score).cast("double").alias("threshold"),
                   F.when(F.col("N") > 0, fp / F.col("N")).alias("fpr"),
                   F.when(F.col("P") > 0, tp / F.col("P")).alias("tpr"),
                   "pos", "neg", "P", "N", "_prev_pos", "_prev_neg", "_before_pos", "_before_neg")
    if drop_intermediate:
        # keep the lowest and highest score and every point where the step changes
        top = ((F.col("_before_pos") + F.col("pos") == F.col("P"))
               & (F.col("_before_neg") + F.col("neg") == F.col("N")))
        keep = (F.col("_prev_pos").isNull() | top
                | (F.col("_prev_pos") != F.col("pos")) | (F.col("_prev_neg") != F.col("neg")))
        pts = pts.filter(keep)
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts.select("threshold", "fpr", "tpr"))
