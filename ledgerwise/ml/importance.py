"""Permutation importance of any fitted classifier, on tables of any size.

A column is permuted without collecting it: every row has a place in the order of one hash
of its id and a place in the order of another, and takes the column's value from the row
whose second place equals its first. Both orders come from range-partitioned prefix sums, the exchange
is one join on the place, and all columns are scored in one table: each row once as
it is and once for each column with that column's value exchanged. The areas under the ROC curve of
all columns come from one set of running sums.

Importance is the loss of area; a column the model does not use scores exactly 0, a useless one
about 0. Rows without a label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import ranks
from ..session import materialize

NO_COLUMN = ""   # the name under which the untouched rows are scored
TASK_SCORES = 20_000   # rows that one task scores: few bytes, but hundreds of trees each


def _places(df: DataFrame, order: Column, out: str) -> DataFrame:
    """Adds the place (from 0) of each row in the given order, ties by the id."""
    keyed = df.withColumns({"_order": order, "_one": F.lit(1)})
    return ranks.prefix_sums(keyed, ["_order", "_id"], ["_one"]).withColumn(out, F.col("_before__one")).drop("_order", "_one", "_before__one")


def permuted_rows(df: DataFrame, cols: Sequence[str], id_col: str = S.ID_COL, keep: Sequence[str] = (), seed: int = 42,
                  orders: tuple[Column, Column] | None = None, task_rows: int | None = None) -> DataFrame:
    """(permuted, id, keep..., cols...): the rows as they are (``permuted`` is ``NO_COLUMN``) and, for
    each column, with that column's values exchanged between rows. ``orders`` replaces the two hashes
    of the id (``_id``); ids must be unique. ``task_rows`` deals the result out to as many tasks as it has so many rows:
    by its bytes alone, Spark would give thousands of rows with all their variants to one."""
    take, give = orders or (F.xxhash64("_id", F.lit(seed)), F.xxhash64("_id", F.lit(seed + 1)))
    rows = df.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.struct(*cols).alias("_own"))
    placed = materialize(_places(rows, take, "_place"), "permuted-places")
    donors = _places(placed.select("_id", F.col("_own").alias("_other")), give, "_place").drop("_id")
    both = placed.join(donors, "_place")
    if task_rows:
        both = both.repartition(max(1, -(-placed.count() * (len(cols) + 1) // task_rows)), "_place")
    variants = [F.struct(F.lit(NO_COLUMN).alias("permuted"), *[F.col(f"_own.{c}").alias(c) for c in cols])]
    for name in cols:
        variants.append(F.struct(F.lit(name).alias("permuted"), *[F.col(f"{'_other' if c == name else '_own'}.{c}").alias(c) for c in cols]))
    out = both.select(F.col("_id").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.explode(F.array(*variants)).alias("_v"))
    return out.select("_v.permuted", id_col, *keep, *[f"_v.{c}" for c in cols])


def auc_by_group(scored: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """(group, auc_roc): exact areas (ties count half) of all groups by one set of running sums; null where
    a group has one class only."""
    pos, neg = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)), F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    table = scored.groupBy(group, score).agg(pos.cast("long").alias("_pos"), neg.cast("long").alias("_neg"))
    run = ranks.prefix_sums(table, [group, score], ["_neg"])
    sums = run.groupBy(group).agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n"), F.min("_before__neg").alias("start"),
                                  F.sum(F.col("_pos") * (F.col("_before__neg") + F.col("_neg") / F.lit(2.0))).alias("below"))
    both = F.col("p").cast("double") * F.col("n")
    return sums.select(group, F.when(both > 0, (F.col("below") - F.col("start") * F.col("p")) / both).alias("auc_roc"))


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str] = S.MODEL_FEATURES, label: str = S.LABEL_COL,
                           id_col: str = S.ID_COL, seed: int = 42) -> DataFrame:
    """(feature, auc_roc, importance): the area with the feature permuted, and how much that loses."""
    rows = permuted_rows(df.filter(F.col(label).isNotNull()), features, id_col, [label], seed, task_rows=TASK_SCORES)
    scored = model.transform(rows).select("permuted", F.col(label), vector_to_array("probability")[1].alias("_score"))
    areas = materialize(auc_by_group(scored, "permuted", label, "_score"), "permuted-areas")
    whole = areas.filter(F.col("permuted") == NO_COLUMN).select(F.col("auc_roc").alias("_whole"))
    # one row
    return areas.filter(F.col("permuted") != NO_COLUMN).join(F.broadcast(whole)).select(
        F.col("permuted").alias("feature"), "auc_roc", (F.col("_whole") - F.col("auc_roc")).alias("importance"))
