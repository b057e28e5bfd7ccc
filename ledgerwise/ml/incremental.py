"""Incremental batch scoring: only rows that are new or changed meet the model.

The scores table carries, beside the scores, a hash of everything a score depends on and a
bucket of the id, by which it is partitioned. A run joins the rows to score with the scores there
are on (id, hash, model, version): rows with a partner keep their score, the others are scored.
Only buckets with a new, changed or vanished row are rewritten (dynamic partition overwrite), from
rows that were written aside first, so a run that fails before its last step changes nothing
and one that is run again finishes the work. A run over unchanged rows scores and writes none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import materialize
from ..sources.lakehouse import Lakehouse
from .score import score_rows

BUCKETS = 64


@dataclass
class ScoringRun:
    scores: DataFrame     # the whole table, in the shape of ``gold_fraud_scores``
    scored: int           # rows that met the model
    kept: int             # rows whose score stayed
    removed: int          # rows of the table that are no longer there
    buckets: int          # buckets rewritten


def row_hash(cols: Sequence[str]):
    """A hash of the inputs; a null differs from every value, columns do not run together."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def score_incremental(lake: Lakehouse, model: PipelineModel, df: DataFrame, model_name: str, model_version: str,
                      features: Sequence[str] = S.MODEL_FEATURES, name: str = S.GOLD_SCORES + "_incremental",
                      buckets: int = BUCKETS) -> ScoringRun:
    """Brings the scores table up to the rows of ``df`` and the given model. Ids must be unique."""
    if lake.catalog:
        raise ValueError("incremental scores live in a path-based table")
    spark = lake.spark
    inputs = [*dict.fromkeys([*features, S.AMOUNT_COL, S.LABEL_COL])]
    # numbered by content and place of storage; the bucket follows the id
    rows = df.withColumns({"row_hash": row_hash(inputs), "bucket": F.pmod(F.xxhash64(S.ID_COL), F.lit(buckets)).cast("int")})
    key = rows.select(S.ID_COL, "row_hash", "bucket")
    there = lake.exists(name)
    old = spark.read.format(lake.fmt).schema(_table_schema()).load(lake.path(name)) if there else None
    if old is None:
        todo, kept, gone = rows, None, None
    else:
        good = old.filter((F.col("model_name") == model_name) & (F.col("model_version") == str(model_version)))
        kept = good.join(key.select(S.ID_COL, "row_hash"), [S.ID_COL, "row_hash"], "left_semi")
        todo = rows.join(good.select(S.ID_COL, "row_hash"), [S.ID_COL, "row_hash"], "left_anti")
        gone = old.join(key.select(S.ID_COL, "row_hash"), [S.ID_COL, "row_hash"], "left_anti")
    todo = materialize(todo, "scoring-todo")
    changed = todo.select("bucket")
    if gone is not None:
        stale = old.filter((F.col("model_name") != model_name) | (F.col("model_version") != str(model_version)))
        changed = changed.unionByName(gone.select("bucket")).unionByName(stale.select("bucket"))
    touched = [r["bucket"] for r in changed.distinct().collect()]  # at most ``buckets`` numbers
    n_todo = todo.count()
    n_kept = kept.count() if kept is not None else 0
    n_gone = gone.join(key.select(S.ID_COL), S.ID_COL, "left_anti").count() if gone is not None else 0
    if touched or not there:
        fresh = score_rows(model, todo, model_name, model_version).join(
            todo.select(F.col(S.ID_COL).cast("int").alias(S.ID_COL), "row_hash", "bucket"), S.ID_COL)
        if kept is not None:
            fresh = fresh.unionByName(kept.filter(F.col("bucket").isin(touched)))
        fresh = materialize(fresh, "scoring-buckets")
        (fresh.repartition(F.col("bucket")).write.format(lake.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").save(lake.path(name)))
        left = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}
        for b in set(touched) - left:  # a bucket that lost its last row
            lake._delete(lake.path(f"{name}/bucket={b}"))
    whole = spark.read.format(lake.fmt).schema(_table_schema()).load(lake.path(name))
    return ScoringRun(whole.select(*S.SCORES_SCHEMA.names), n_todo, n_kept, n_gone, len(touched))


def _table_schema():
    from pyspark.sql import types as T
    return T.StructType([*S.SCORES_SCHEMA.fields, T.StructField("row_hash", T.LongType()), T.StructField("bucket", T.IntegerType())])
