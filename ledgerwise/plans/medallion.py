"""The batch job: bronze -> silver -> gold -> training -> scoring -> views.

Each stage writes its table and hands the next stage a scan of what was
written (lineage cut at every layer, counts read from the table).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..ml import split as SP
from ..ml import train as TR
from ..ml.registry import Tracker
from ..ml.score import model_performance, prediction_distribution, risk_distribution, score_rows
from ..operators import aggregates as A
from ..operators import features as FE
from ..operators import quality as Q
from ..sources.catalog import drop_columns
from ..sources.files import cast_schema
from ..sources.lakehouse import Lakehouse
from ..session import materialize, stage_scope
from . import reports as RP


def add_provenance(df: DataFrame, source: str, endpoint: str) -> DataFrame:
    return df.select("*", F.current_timestamp().alias("ingestion_timestamp"),
                     F.lit(source).alias("data_source"), F.lit(endpoint).alias("source_endpoint"))


def build_bronze(lake: Lakehouse, raw: DataFrame, source: str, endpoint: str) -> DataFrame:
    return lake.write(add_provenance(raw, source, endpoint), S.BRONZE)


def silver_frame(bronze: DataFrame, strict_cast: bool = False, stamp: bool = True, ranks: bool = True) -> DataFrame:
    """Dedup by id, cast, engineer features; provenance dropped.

    The deduplicated, typed rows are materialized once (parquet under the
    checkpoint folder) because the rank features read them several times.
    Without ``ranks`` (for what reads neither rank column) nothing runs ahead.
    """
    base = drop_columns(bronze, [*S.PROVENANCE_COLS, "source_file"])
    typed = cast_schema(Q.dedupe(base, [S.ID_COL]), S.SILVER_TYPES, strict=strict_cast)
    out = FE.engineer(materialize(typed, "silver-typed") if ranks else typed, ranks)
    return out.withColumn("silver_processed_at", F.current_timestamp()) if stamp else out


def build_silver(lake: Lakehouse, bronze: DataFrame, gate: bool = True, **kw) -> DataFrame:
    """Write, audit, publish: the rows go to a staging place, the nine checks read three
    columns of what was written, and only rows that pass replace the table. (An ``Observation``
    would collect them while writing, but once a session has made one, Spark 4.1 can no longer
    serialise the linear models fitted in it.)

    Deduplicated ids stay distinct unless a cast maps several to one; only then does counting
    them need a shuffle."""
    frame = silver_frame(bronze, **kw)
    if not gate:
        return lake.write(frame, S.SILVER)
    distinct = bronze.schema[S.ID_COL].dataType == S.SILVER_TYPES[S.ID_COL]
    return lake.write_audited(frame, S.SILVER, lambda rows: Q.assert_quality(rows.agg(*Q.quality_checks(unique=distinct))))


def build_gold(lake: Lakehouse, silver: DataFrame) -> dict[str, DataFrame]:
    return {
        S.GOLD_BY_AMOUNT: lake.write(A.fraud_by_amount(silver), S.GOLD_BY_AMOUNT),
        S.GOLD_BY_QUARTILE: lake.write(A.fraud_by_quartile(silver), S.GOLD_BY_QUARTILE),
        S.GOLD_KPIS: lake.write(A.kpis(silver), S.GOLD_KPIS),
        S.GOLD_FEATURE_SUMMARY: lake.write(A.feature_summary(silver), S.GOLD_FEATURE_SUMMARY),
    }


def train_models(lake: Lakehouse, silver: DataFrame, kinds=("lr", "rf", "gbt"),
                 params: dict | None = None, test_frac: float = 0.2, seed: int = 42) -> tuple[Tracker, list]:
    """Exact stratified split, then one fit per model kind; the split frame
    is materialized once and reused by every fit. The fits run side by side."""
    tracker = Tracker(lake)
    cols = [S.ID_COL] + S.MODEL_FEATURES + [S.AMOUNT_COL, S.LABEL_COL]
    sp = materialize(SP.stratified_split(silver.select(*cols), test_frac, seed), "split")
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    return tracker, TR.train_all(train, test, kinds, tracker, params)


def score_all(lake: Lakehouse, tracker: Tracker, silver: DataFrame, scaler: str = "saved") -> tuple[DataFrame, DataFrame]:
    """Register the best run, score every silver row with it, write scores
    and the performance row; the name/version written are the ones used."""
    reg = tracker.register_best()
    model, info = tracker.load(reg["name"], reg["version"])
    scores = lake.write(score_rows(model, silver, reg["name"], str(reg["version"]), scaler), S.GOLD_SCORES)
    perf = lake.write(model_performance(scores, reg["name"], reg["version"]), S.GOLD_PERFORMANCE)
    return scores, perf


@dataclass
class MedallionResult:
    bronze: DataFrame
    silver: DataFrame
    gold: dict
    runs: list = field(default_factory=list)
    scores: DataFrame | None = None
    performance: DataFrame | None = None
    views: dict = field(default_factory=dict)
    roc: DataFrame | None = None
    prediction_distribution: DataFrame | None = None
    risk_distribution: DataFrame | None = None


def run_medallion(spark: SparkSession, raw: DataFrame, source: str, endpoint: str, lake: Lakehouse | None = None,
                  kinds=("lr", "rf", "gbt"), params: dict | None = None) -> MedallionResult:
    """Bronze -> silver (with quality gate) -> gold -> training -> scoring ->
    views. Intermediate tables are removed at the end; every result is a scan of
    a table of ``lake``."""
    lake = lake or Lakehouse.scratch(spark)
    with stage_scope(spark):
        bronze = build_bronze(lake, raw, source, endpoint)
        silver = build_silver(lake, bronze)
        gold = build_gold(lake, silver)
        res = MedallionResult(bronze, silver, gold)
        tables = dict(gold)
        if kinds:
            tracker, res.runs = train_models(lake, silver, kinds, params)
            res.roc = lake.write(RP.roc_by_model({r.kind: r.roc for r in res.runs}), S.ROC)
            res.scores, res.performance = score_all(lake, tracker, silver)
            res.prediction_distribution = prediction_distribution(res.scores)
            res.risk_distribution = risk_distribution(res.scores)
            tables |= {S.GOLD_SCORES: res.scores, S.GOLD_PERFORMANCE: res.performance}
        for r in res.runs:  # these read intermediate tables; roc and the artifacts are written
            r.scored = r.roc = r.confusion = None
        res.views = RP.publish_views(tables)
    return res
