"""Adapters from the driver's test tables to the transaction shape.

``txn``: every ``events`` row joined to an ``embeddings`` row on
``event_id % n = vec_id`` (``n`` = number of embeddings), giving
``id, V1..V28, Amount, Class``. ``txn_ml``: one row per embedding, so no
vector sits on both sides of a train/test split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import V_COLS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _v_cols(arr: Column) -> list[Column]:
    return [F.element_at(arr, i).cast("double").alias(c) for i, c in enumerate(V_COLS, start=1)]


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions view over ``events`` and ``embeddings``.

    The embedding count is a parquet-footer count read once on the driver and
    used as a literal (a scalar subquery in the join condition misbehaves on
    cached plans). The join is an equi-join on a computed key; AQE picks a
    broadcast only when the runtime size of ``embeddings`` is under the
    broadcast threshold, otherwise a sort-merge join.
    """
    emb = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n, low, high = emb.agg(F.count(F.lit(1)), F.min("vec_id"), F.max("vec_id")).first()
    if (low, high) != (0, n - 1):
        raise ValueError("vec_id must run from 0 to the number of embeddings less one")
    ev = _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    ev = ev.withColumn("_vec", F.col("event_id") % F.lit(n))
    j = ev.join(emb, ev["_vec"] == emb["vec_id"], "inner")
    return j.select(
        F.col("event_id").cast("int").alias("id"),
        *_v_cols(F.col("embedding")),
        F.col("value").cast("double").alias("Amount"),
        F.when(F.col("event_type") == F.lit("error"), F.lit(1)).otherwise(F.lit(0)).alias("Class"),
    )


def txn_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-fitting view: one row per embedding, label from ``label < 5``."""
    emb = _table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("int").alias("id"),
        *_v_cols(F.col("embedding")),
        (F.lit(1.0) + F.lit(100.0) * F.abs(F.element_at("embedding", 29).cast("double"))).alias("Amount"),
        F.when(F.col("label") < F.lit(5), F.lit(1)).otherwise(F.lit(0)).alias("Class"),
    )


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders")


# DuckDB text of the same views, for the oracle queries.
_V_SQL = ", ".join(f"CAST(e.embedding[{i}] AS DOUBLE) AS {c}" for i, c in enumerate(V_COLS, start=1))
TXN_SQL = (
    "SELECT CAST(v.event_id AS INTEGER) AS id, " + _V_SQL + ", "
    "CAST(v.value AS DOUBLE) AS Amount, "
    "CAST(CASE WHEN v.event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS Class "
    "FROM events v CROSS JOIN (SELECT count(*) AS n FROM embeddings) z "
    "JOIN embeddings e ON v.event_id % z.n = e.vec_id"
)
TXN_ML_SQL = (
    "SELECT CAST(e.vec_id AS INTEGER) AS id, " + _V_SQL + ", "
    "1.0 + 100.0 * abs(CAST(e.embedding[29] AS DOUBLE)) AS Amount, "
    "CAST(CASE WHEN e.label < 5 THEN 1 ELSE 0 END AS INTEGER) AS Class FROM embeddings e"
)
