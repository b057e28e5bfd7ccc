"""Feature engineering on the typed transactions, as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..session import materialize
from . import ranks


def add_scalar_features(df: DataFrame, amount: str = S.AMOUNT_COL) -> DataFrame:
    """Log, bins, absolute values and interactions in a single ``select``
    (no chain of ``withColumn``), so the plan is one Project inside codegen."""
    log_col = C.log1p(amount)
    return df.select(
        "*",
        log_col.alias("Amount_log"),
        C.left_closed_bins(amount, S.AMOUNT_EDGES, S.AMOUNT_LABELS).alias("Amount_category"),
        *[C.abs_(c).alias(f"{c}_abs") for c in S.ABS_COLS],
        C.interaction("V1", "V2").alias("V1_V2_interaction"),
        C.interaction(F.col("V1"), log_col).alias("V1_Amount_interaction"),
    )


def add_rank_features(df: DataFrame, amount: str = S.AMOUNT_COL, tiebreak: str = S.ID_COL) -> DataFrame:
    """``Amount_percentile`` (percent_rank rounded to 4) and ``Amount_quartile``
    (ntile 4, ties broken by ``id``) over the whole table. Both are read off one
    table of ranked amounts first and applied as projections."""
    ranked = materialize(ranks.ranked_values(df, amount), "ranked-amounts")
    tile = ranks.ntile_column(df, amount, 4, tiebreak, ranked=ranked)
    steps = ranks.percent_rank_steps(ranked, amount, 4)
    return ranks.apply_percent_rank(df, amount, "Amount_percentile", steps).withColumn("Amount_quartile", tile)


def engineer(df: DataFrame, ranks: bool = True) -> DataFrame:
    """All features; the ranks are found on the narrow input columns. Without
    ``ranks`` the two rank columns are left out, and no job runs."""
    scalar = add_scalar_features(df)
    return add_rank_features(scalar) if ranks else scalar
