"""Registered queries over the driver's test tables, with DuckDB oracle SQL.

Every query reads the given tables (through the ``txn`` / ``txn_ml`` views
of ``sources.fixtures``) and runs over all of their rows. Computed columns
carry the same names in the Spark result and the SQL text. Doubles that
depend on summation order or on a transcendental function are rounded the
same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.columns import left_closed_bins, right_closed_bins
from ..ml import boosting as BO
from ..ml import importance as PI
from ..ml import split as SP
from ..ml import train as TR
from ..ml.incremental import score_incremental
from ..ml.registry import Tracker
from ..ml.scale import zscore
from ..ml.score import model_performance, prediction_distribution, risk_distribution, score_rows
from ..ml.split_stable import stable_split
from ..operators import aggregates as A
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import ranks as R
from ..sources import fixtures as FX
from ..sources import quarantine as QU
from ..sources.catalog import preview
from ..sources.files import cast_rejects
from ..sources.lakehouse import Lakehouse
from ..session import materialize
from . import medallion as MD
from . import reports as RP

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
ROUND_LOG = 8       # log-derived columns (log1p vs ln(1+x) differ in the last bit)
ROUND_STAT = 6      # correlations, z-scores, quantiles
ROUND_METRIC = 10   # ranking metrics (sums in different order)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return MD.add_provenance(FX.txn(spark, sf), "test_tables", sf)


def _silver(spark: SparkSession, sf: str, ranks: bool = True) -> DataFrame:
    return MD.silver_frame(_bronze(spark, sf), stamp=False, ranks=ranks)


def _silver_ml(spark: SparkSession, sf: str) -> DataFrame:
    return MD.silver_frame(FX.txn_ml(spark, sf), stamp=False)


def _score(df: DataFrame) -> DataFrame:
    """A fixed formula score in [0, 1) for the metric checks (no fitted model)."""
    a = F.abs(F.col("V1")) + F.abs(F.col("V2"))
    return df.withColumn("score", a / (F.lit(1.0) + a)) \
        .withColumn("prediction", F.when(F.col("score") > 0.5, F.lit(1)).otherwise(F.lit(0)))


def q_class_balance(spark, sf):
    return A.class_balance(FX.txn(spark, sf))


def q_label_rate_pct(spark, sf):
    return A.label_rate_pct(FX.txn(spark, sf))


def _holed(t: DataFrame) -> DataFrame:
    """``txn`` with nulls in every column and NaN in the double ones, by id."""
    def holes(c, i):
        out = F.when(F.col("id") % (i + 3) == 0, F.lit(None))
        if c not in ("id", "Class"):
            out = out.when(F.col("id") % 11 == 1, F.lit(float("nan")))
        return out.otherwise(F.col(c)).alias(c)
    return t.select(*[holes(c, i) for i, c in enumerate(_ALL_TXN)])


def q_null_counts(spark, sf):
    return Q.null_counts(_holed(FX.txn(spark, sf)))


def q_quality_summary_flags(spark, sf):
    """The quality summary of rows with missing labels and negative amounts."""
    t = FX.txn(spark, sf).select("id", F.when(F.col("id") % 17 == 0, -F.col("Amount")).otherwise(F.col("Amount")).alias("Amount"),
                                 F.when(F.col("id") % 13 != 0, F.col("Class")).alias("Class"))
    return Q.quality_summary(t)


def q_duplicate_report(spark, sf):
    return Q.duplicate_report(FX.lineitem(spark, sf), LINEITEM_KEYS)


def q_dedupe(spark, sf):
    return Q.dedupe(FX.lineitem(spark, sf), LINEITEM_KEYS)


def q_quality_summary(spark, sf):
    return Q.quality_summary(_silver(spark, sf, ranks=False))


def q_silver_features(spark, sf):
    s = _silver(spark, sf)
    return s.withColumn("Amount_log", F.round("Amount_log", ROUND_LOG)) \
        .withColumn("V1_Amount_interaction", F.round("V1_Amount_interaction", ROUND_LOG))


def q_amount_percentile(spark, sf):
    t = FX.txn(spark, sf).select("id", "Amount")
    return R.with_percent_rank(t, "Amount", "Amount_percentile", 4)


def q_amount_quartile(spark, sf):
    t = FX.txn(spark, sf).select("id", "Amount")
    return R.with_ntile(t, "Amount", 4, "id", "Amount_quartile")


def q_orders_percentile(spark, sf):
    o = FX.orders(spark, sf).select("o_orderkey", "o_totalprice")
    o = R.with_percent_rank(o, "o_totalprice", "price_percentile", 4)
    return R.with_ntile(o, "o_totalprice", 4, "o_orderkey", "price_quartile")


def _orders_tied(spark, sf):
    """Orders by a rounded price (heavy ties) with the key as a string."""
    return FX.orders(spark, sf).select(F.col("o_orderkey").cast("string").alias("id"), F.round(F.col("o_totalprice") / 20000).alias("price"))


def q_quartile_string_id(spark, sf):
    """Ties broken by a string key; few candidates and many ranges, so that
    slices and range offsets all take part."""
    return R.with_ntile(_orders_tied(spark, sf), "price", 4, "id", "quartile", grid=8, sample_rows=200, partitions=16)


def q_quartile_hot_value(spark, sf):
    """A third of ``lineitem`` on one value."""
    li = FX.lineitem(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("price"))
    li = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                   F.when(F.col("l_orderkey") % 3 == 0, F.lit(30000.0)).otherwise(F.col("price")).alias("price"))
    li = R.with_ntile(materialize(li, "hot"), "price", 4, "id", "quartile", grid=4, sample_rows=500, partitions=24)
    return R.with_percent_rank(li, "price", "percentile", 4, partitions=24)


def q_percentile_refined(spark, sf):
    """Percent ranks of a string column and of longs beyond 2**53."""
    o = _orders_tied(spark, sf).withColumn("big", F.lit(2**53) + F.col("id").cast("long"))
    return R.with_percent_rank(R.with_percent_rank(o, "id", "id_rank", 4, partitions=16), "big", "big_rank", 4, partitions=16)


def q_fraud_by_amount(spark, sf):
    return A.fraud_by_amount(_silver(spark, sf, ranks=False))


def q_fraud_by_order_price(spark, sf):
    """The amount bins over a 200th of ``orders.o_totalprice``: all four occur."""
    o = FX.orders(spark, sf).select(
        (F.col("o_totalprice") / F.lit(200.0)).alias("Amount"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("Class"))
    return A.fraud_by_amount(o.withColumn("Amount_category", left_closed_bins("Amount", S.AMOUNT_EDGES, S.AMOUNT_LABELS)))


def q_fraud_by_quartile(spark, sf):
    return A.fraud_by_quartile(_silver(spark, sf))


def q_kpis(spark, sf):
    return A.kpis(_silver(spark, sf, ranks=False), stamp=False)


def q_feature_summary(spark, sf):
    return A.feature_summary(_silver(spark, sf, ranks=False))


def q_value_counts(spark, sf):
    return A.value_counts(FX.txn(spark, sf), "Class")


def q_class_distribution(spark, sf):
    return P.class_distribution(FX.txn(spark, sf))


def q_preview_ordered(spark, sf):
    FX.txn(spark, sf).select("id", "Amount", "Class").orderBy("id").createOrReplaceTempView("txn_by_id")
    return preview(spark, "txn_by_id", 1000)


def q_histogram_by_class(spark, sf):
    h = P.histogram(_silver(spark, sf, ranks=False), ["Amount", "Amount_log"], 50, "Class")
    return h.withColumn("bin_lo", F.round("bin_lo", ROUND_LOG)).withColumn("bin_hi", F.round("bin_hi", ROUND_LOG))


CORR_COLS = S.V_COLS + ["Amount"]


def q_label_correlation(spark, sf):
    return P.label_correlation(FX.txn(spark, sf), CORR_COLS, "Class", digits=ROUND_STAT)


def q_top_correlated(spark, sf):
    return P.top_correlated(FX.txn(spark, sf), 10, CORR_COLS, "Class", digits=ROUND_STAT)


def q_correlation_matrix(spark, sf):
    t = FX.txn(spark, sf)
    top = [r["feature"] for r in P.top_correlated(t, 10, CORR_COLS, "Class").collect()]
    return P.correlation_matrix(t, top + ["Class"], digits=ROUND_STAT)


def q_box_stats(spark, sf):
    t = FX.txn(spark, sf)
    top = [r["feature"] for r in P.top_correlated(t, 6, CORR_COLS, "Class").collect()]
    b = P.box_stats(t, top, "Class")
    for c in ("q1", "median", "q3", "iqr"):
        b = b.withColumn(c, F.round(c, ROUND_STAT))
    return b


def q_split_report(spark, sf):
    s = SP.stratified_split(FX.txn_ml(spark, sf), 0.2, 42)
    return SP.split_report(s)


def q_split_report_txn(spark, sf):
    s = SP.stratified_split(FX.txn(spark, sf), 0.2, 42)
    return SP.split_report(s)


def q_zscore(spark, sf):
    return zscore(FX.txn(spark, sf).select("id", *CORR_COLS), CORR_COLS, digits=ROUND_STAT)


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_score(FX.txn(spark, sf)), "Class", "prediction")


def q_classification_metrics(spark, sf):
    return M.classification_metrics(_score(FX.txn(spark, sf)), "Class", "prediction")


def q_auc_roc(spark, sf):
    a = M.auc_roc(_score(FX.txn(spark, sf)), "Class", "score")
    return a.select(F.round("auc_roc", ROUND_METRIC).alias("auc_roc"))


def q_average_precision(spark, sf):
    a = M.average_precision(_score(FX.txn(spark, sf)), "Class", "score")
    return a.select(F.round("average_precision", ROUND_METRIC).alias("average_precision"))


def q_roc_points(spark, sf):
    r = M.roc_points(_score(FX.txn(spark, sf)), "Class", "score")
    return r.select("threshold", F.round("fpr", ROUND_METRIC).alias("fpr"),
                    F.round("tpr", ROUND_METRIC).alias("tpr"))


def _formula_scores(spark, sf) -> DataFrame:
    """``gold_fraud_scores`` shape from the fixed formula score (no stamp)."""
    t = _score(FX.txn(spark, sf))
    # spread over [0, 1], so that all bands occur
    return t.select("id", "Amount", "Class", F.col("prediction").cast("long").alias("fraud_prediction"),
                    F.bround(F.least(F.lit(1.0), F.col("score") * F.lit(2.5)), 6).alias("fraud_probability"),
                    F.lit("formula").alias("model_name"), F.lit("1").alias("model_version")) \
        .withColumn("risk_category", right_closed_bins("fraud_probability", S.RISK_EDGES, S.RISK_LABELS))


def q_risk_bands(spark, sf):
    return risk_distribution(_formula_scores(spark, sf))


def q_prediction_distribution(spark, sf):
    return prediction_distribution(_formula_scores(spark, sf))


def q_roc_by_model(spark, sf):
    """ROC points of two scores in one table."""
    t = _score(FX.txn(spark, sf)).withColumn("score2", F.round(F.abs("V3"), 2))
    r = RP.roc_by_model({"v1_v2": M.roc_points(t, "Class", "score"), "v3": M.roc_points(t, "Class", "score2")})
    return r.select("model", "threshold", F.round("fpr", ROUND_METRIC).alias("fpr"), F.round("tpr", ROUND_METRIC).alias("tpr"))


def q_scores_page(spark, sf):
    return RP.scores_page(RP.typed_view(_formula_scores(spark, sf), S.GOLD_SCORES), "Medium")


def q_executive_summary(spark, sf):
    return RP.executive_summary(RP.typed_view(q_kpis(spark, sf), S.GOLD_KPIS))


def q_fraud_analysis(spark, sf):
    s = _silver(spark, sf)
    return RP.fraud_analysis(RP.typed_view(A.fraud_by_amount(s), S.GOLD_BY_AMOUNT),
                             RP.typed_view(A.fraud_by_quartile(s), S.GOLD_BY_QUARTILE))


def q_report_aggregate(spark, sf):
    return RP.report_aggregate(RP.typed_view(q_fraud_by_amount(spark, sf), S.GOLD_BY_AMOUNT))


def q_report_by_risk(spark, sf):
    """The default sums of the scores view, by its bands and models."""
    r = RP.report_aggregate(RP.typed_view(_formula_scores(spark, sf), S.GOLD_SCORES), ["risk_category", "model_name"])
    return r.withColumn("sum_Amount", F.round("sum_Amount", 2))


def q_box_stats_null_class(spark, sf):
    """Box statistics where a fifth of the rows has no class: they are a group of their own."""
    t = FX.txn(spark, sf).withColumn("Class", F.when(F.col("id") % 5 != 0, F.col("Class")))
    b = P.box_stats(t, NULL_CLASS_COLS, "Class")
    return b.withColumns({c: F.round(c, ROUND_STAT) for c in ("q1", "median", "q3", "iqr")})


NULL_CLASS_COLS = ["V1", "V2", "Amount"]


def q_split_stable(spark, sf):
    """The side of each row by a threshold on its own hash, one for each class."""
    return stable_split(FX.txn(spark, sf).select("id", "Class"), {0: 0.2, 1: 0.35})


def q_quarantine(spark, sf):
    """Lines that landed, by what became of them: every tenth key, every seventh price and every
    eleventh line's number of fields is damaged on the way."""
    k = F.col("o_orderkey")
    line = F.concat_ws(",", F.concat(F.when(k % 10 == 0, F.lit("k")).otherwise(F.lit("")), k.cast("string")),
                       F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")), F.when(k % 11 != 0, F.col("o_orderstatus")))
    lake = Lakehouse.scratch(spark, "landing")
    FX.orders(spark, sf).select(line.alias("line")).write.text(lake.path("raw"))
    fits = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("price", T.DoubleType()), T.StructField("status", T.StringType())])
    got = QU.land(lake, lake.path("raw"), fits)
    return QU.quarantine_summary(got.rejected).unionByName(got.accepted.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("lines")))


def q_incremental_scores(spark, sf):
    """How many rows four runs in a row score, keep and remove: part of the rows, the same again,
    all but others with every seventh row changed, and the same under another model version."""
    t = FX.txn_ml(spark, sf).select("id", "V1", "V2", "Amount", "Class")
    model = TR.fit_pipeline(t, "lr", ["V1", "V2"], {"max_iter": 5})
    part = t.filter(F.col("id") % 10 != 0)
    later = t.filter(F.col("id") % 10 != 1).withColumn("Amount", F.when(F.col("id") % 7 == 0, F.col("Amount") + 1).otherwise(F.col("Amount")))
    lake, out = Lakehouse.scratch(spark, "incremental"), []
    for i, (rows, version) in enumerate(((part, "1"), (part, "1"), (later, "1"), (later, "2")), 1):
        r = score_incremental(lake, model, rows, "m", version, ["V1", "V2"], buckets=16)
        out.append((i, r.scored, r.kept, r.removed, r.scores.count()))
    return spark.createDataFrame(out, "run int, scored long, kept long, removed long, rows long")


PERMUTED = ["V1", "V2"]


def q_permuted_auc(spark, sf):
    """The formula score's area as it is and with a column's values exchanged between rows."""
    order = [F.md5(F.concat(F.lit(f"{s}:"), F.col("_id").cast("string"))) for s in ("take", "give")]
    rows = PI.permuted_rows(FX.txn(spark, sf), PERMUTED, keep=["Class"], orders=tuple(order))
    areas = PI.auc_by_group(_score(rows), "permuted", "Class", "score")
    return areas.select("permuted", F.round("auc_roc", ROUND_METRIC).alias("auc_roc"))


COARSE = ["V1", "V2", "V3"]


def q_gbt_root_split(spark, sf):
    """The first split of the first boosted tree over all transactions, its gain and its leaves."""
    t = FX.txn(spark, sf).select("Class", *[F.round(F.col(c) * 8).alias(c) for c in COARSE])
    body = BO.fit_boosted(t, COARSE, "Class", BO.BoostParams(n_estimators=1, max_depth=1)).body
    tree = body["trees"][0]
    row = (COARSE[tree["feature"][0]], float(tree["border"][0]), round(tree["gain"][0], 6), round(tree["value"][1], 8), round(tree["value"][2], 8))
    return spark.createDataFrame([row], "feature string, border double, gain double, left_value double, right_value double")


def q_cast_rejects(spark, sf):
    """Text values that do not convert to the silver types."""
    o = FX.orders(spark, sf)
    key = F.col("o_orderkey").cast("string")
    text = o.select(F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("k"), key)).otherwise(key).alias("id"),
                    F.col("o_orderpriority").alias("V1"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("Amount"),
                    F.col("o_orderstatus").alias("Class"))
    return cast_rejects(text, S.SILVER_TYPES)


def _md5_key(seed: int = 42):
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string")))


def q_split_members(spark, sf):
    """Which side each row is on, ordered by a hash both engines have."""
    s = SP.stratified_split(FX.txn(spark, sf).select("id", "Class"), 0.2, key=_md5_key())
    return s.select("id", "Class", "split")


# --- model queries: a fit can't be restated in SQL, its invariants can -----------

def _ml_frames(spark, sf, silver: DataFrame | None = None):
    s = _silver_ml(spark, sf) if silver is None else silver
    cols = [S.ID_COL] + S.MODEL_FEATURES + [S.AMOUNT_COL, S.LABEL_COL]
    sp = SP.stratified_split(s.select(*cols), 0.2, key=_md5_key())
    sp = materialize(sp, "split")
    return sp.filter(F.col("split") == "train").drop("split"), sp.filter(F.col("split") == "test").drop("split")


_EXPERIMENTS: dict[tuple, dict] = {}
KINDS = ("lr", "rf", "gbt")


def _experiment(spark, sf, kinds=KINDS) -> dict:
    """One experiment per session and scale factor. A model is trained when a query
    first asks for its kind, and its run is logged to a runs table; the queries share
    the silver rows, the split and the runs."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _EXPERIMENTS:
        silver = _silver_ml(spark, sf)
        train, test = _ml_frames(spark, sf, silver)
        _EXPERIMENTS[key] = {"tracker": Tracker(Lakehouse.scratch(spark, "experiments")), "runs": {}, "silver": silver,
                             "train": train, "test": test, "base": TR.TrainBase.of(train)}
    e = _EXPERIMENTS[key]
    TR.train_all(e["train"], e["test"], [k for k in kinds if k not in e["runs"]], e["tracker"], base=e["base"], into=e["runs"])
    return e


def _fit_scores(kind: str):
    """The hold-out rows with checks of what the model gave each of them."""
    def q(spark, sf):
        p, raw = F.col("fraud_probability"), F.col("_p_raw")
        return _experiment(spark, sf, (kind,))["runs"][kind].scored.select(
            "id", "Amount", "Class", p.between(0, 1).alias("probability_ok"),
            ((F.col("fraud_prediction") == 1) == (raw > 0.5)).alias("prediction_ok"), (p == F.bround(raw, 6)).alias("rounded_ok"))
    return q


def q_feature_importance(spark, sf):
    """Importances of the tree models: one per feature, none negative, sum 1."""
    e = _experiment(spark, sf, ("rf", "gbt"))["runs"]
    rows = [(k, f, v) for k in ("rf", "gbt") for f, v in e[k].importances]
    return spark.createDataFrame(rows, "model string, feature string, importance double").groupBy("model").agg(
        F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"))


def _brute_metrics(scored: DataFrame) -> dict:
    """Metrics of a scored table by a second way: the AUC by Spark ML's evaluator over
    every distinct score, the rest from grouped counts."""
    auc = BinaryClassificationEvaluator(rawPredictionCol="_p_raw", labelCol="_y", numBins=0).evaluate(
        scored.select("_p_raw", F.col("Class").cast("double").alias("_y")))
    n = {(x["Class"], x["fraud_prediction"]): x["count"] for x in scored.groupBy("Class", "fraud_prediction").count().collect()}
    tp, fp, fn, tn = (n.get(k, 0) for k in ((1, 1), (0, 1), (1, 0), (0, 0)))
    precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn)
    return {"auc_roc": auc, "accuracy": (tp + tn) / sum(n.values()),
            "precision": precision, "recall": recall,
            "f1_score": 2 * precision * recall / (precision + recall) if precision + recall else 0.0}


def q_gbt_history(spark, sf):
    """The boosting rounds: the training loss never rises, and the last round's loss on the
    hold-out is that of the scored rows."""
    run = _experiment(spark, sf, ("gbt",))["runs"]["gbt"]
    p = F.when(F.col("Class") == 1, F.col("_p_raw")).otherwise(1 - F.col("_p_raw"))
    loss = run.scored.agg(F.avg(-F.log(p))).first()[0]
    h, out = run.history, []
    for i, r in enumerate(h):
        falls = i == 0 or r["train_log_loss"] <= h[i - 1]["train_log_loss"] + 1e-9
        out.append((r["round"], falls, 0 <= r["eval_auc_pr"] <= 1 and (i + 1 < len(h) or abs(r["eval_log_loss"] - loss) < 1e-6)))
    return spark.createDataFrame(out, "round long, loss_falls boolean, eval_ok boolean")


def q_permutation_importance(spark, sf):
    """Every model's loss of area by feature on the hold-out: one row a feature, each within [-1, 1]."""
    e = _experiment(spark, sf)
    out = None
    for k in KINDS:
        part = PI.permutation_importance(e["runs"][k].model, e["test"]).groupBy(F.lit(k).alias("model")).agg(
            F.count_distinct("feature").alias("features"), F.count_if(~F.col("importance").between(-1, 1)).alias("outside"))
        out = part if out is None else out.unionByName(part)
    return out


def q_compare_models(spark, sf):
    """The logged metrics of each run against a second computation, best AUC first."""
    e = _experiment(spark, sf)
    rows = e["tracker"].compare_models().collect()
    out = []
    for i, r in enumerate(rows):
        kind = next(k for k, t in TR.MODEL_TYPES.items() if t == r["model_type"])
        want = _brute_metrics(e["runs"][kind].scored)
        out.append((r["model_type"], all(abs(r[m] - want[m]) < 1e-9 for m in ("auc_roc", "precision", "recall", "f1_score")),
                    i == 0 or rows[i - 1]["auc_roc"] >= r["auc_roc"]))
    return spark.createDataFrame(out, "model_type string, metrics_ok boolean, in_order boolean")


def q_best_run(spark, sf):
    """The best run's AUC is the largest of all runs."""
    t = _experiment(spark, sf)["tracker"]
    top = t.compare_models().agg(F.max("auc_roc").alias("top"), F.count(F.lit(1)).alias("runs"))
    return t.best_run().select(F.col("metrics")["auc_roc"].alias("auc")).join(top, F.col("auc") == F.col("top")).select(
        "runs", (F.col("auc") <= 1.0).alias("auc_ok"))


def _performance(spark, sf) -> dict:
    """Register the best run once, score every ML row with it, and keep scores
    and performance row (written under the checkpoint folder)."""
    e = _experiment(spark, sf)
    if "perf" not in e:
        tracker = e["tracker"]
        reg = tracker.register_best()
        model, _ = tracker.load(reg["name"], reg["version"])
        e["scores"] = materialize(score_rows(model, e["silver"], reg["name"], str(reg["version"]), stamp=False), "scores")
        e["perf"] = materialize(model_performance(e["scores"], reg["name"], reg["version"], stamp=False), "perf")
    return e


def q_model_performance(spark, sf):
    """Totals of the scored table, and its metrics against a second computation."""
    e = _performance(spark, sf)
    want = _brute_metrics(e["scores"].withColumn("_p_raw", F.col("fraud_probability")))
    flagged = e["scores"].filter("fraud_prediction = 1").count()
    ok = F.lit(True)
    for m, v in want.items():
        ok = ok & (F.abs(F.col(m) - F.lit(v)) <= 0.00005 + 1e-9)
    return e["perf"].select("model_name", "model_version", "total_scored", (F.col("total_flagged") == flagged).alias("flagged_ok"),
                            ok.alias("metrics_ok"))


def q_performance_page(spark, sf):
    p = RP.performance_page(RP.typed_view(_performance(spark, sf)["perf"], S.GOLD_PERFORMANCE))
    return p.select("model_name", "model_version", *[F.col(c).between(0, 1).alias(f"{c}_ok") for c in ("auc_roc", "precision", "recall", "f1_score")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "class_balance": q_class_balance,
    "label_rate_pct": q_label_rate_pct,
    "null_counts": q_null_counts,
    "duplicate_report": q_duplicate_report,
    "dedupe": q_dedupe,
    "quality_summary": q_quality_summary,
    "silver_features": q_silver_features,
    "amount_percentile": q_amount_percentile,
    "amount_quartile": q_amount_quartile,
    "orders_percentile": q_orders_percentile,
    "quartile_string_id": q_quartile_string_id,
    "quartile_hot_value": q_quartile_hot_value,
    "percentile_refined": q_percentile_refined,
    "quality_summary_flags": q_quality_summary_flags,
    "split_members": q_split_members,
    "prediction_distribution": q_prediction_distribution,
    "roc_by_model": q_roc_by_model,
    "fraud_by_amount": q_fraud_by_amount,
    "fraud_by_order_price": q_fraud_by_order_price,
    "fraud_by_quartile": q_fraud_by_quartile,
    "kpis": q_kpis,
    "feature_summary": q_feature_summary,
    "value_counts": q_value_counts,
    "class_distribution": q_class_distribution,
    "preview_ordered": q_preview_ordered,
    "histogram_by_class": q_histogram_by_class,
    "label_correlation": q_label_correlation,
    "top_correlated": q_top_correlated,
    "correlation_matrix": q_correlation_matrix,
    "box_stats": q_box_stats,
    "split_report": q_split_report,
    "split_report_txn": q_split_report_txn,
    "zscore": q_zscore,
    "confusion_matrix": q_confusion_matrix,
    "classification_metrics": q_classification_metrics,
    "auc_roc": q_auc_roc,
    "average_precision": q_average_precision,
    "roc_points": q_roc_points,
    "risk_bands": q_risk_bands,
    "scores_page": q_scores_page,
    "executive_summary": q_executive_summary,
    "fraud_analysis": q_fraud_analysis,
    "report_aggregate": q_report_aggregate,
    "cast_rejects": q_cast_rejects,
    "report_by_risk": q_report_by_risk,
    "box_stats_null_class": q_box_stats_null_class,
    "split_stable": q_split_stable,
    "quarantine": q_quarantine,
    "incremental_scores": q_incremental_scores,
    "permuted_auc": q_permuted_auc,
    "gbt_root_split": q_gbt_root_split,
    "gbt_history": q_gbt_history,
    "permutation_importance": q_permutation_importance,
    "lr_scores": _fit_scores("lr"),
    "rf_scores": _fit_scores("rf"),
    "gbt_scores": _fit_scores("gbt"),
    "feature_importance": q_feature_importance,
    "compare_models": q_compare_models,
    "best_run": q_best_run,
    "model_performance": q_model_performance,
    "performance_page": q_performance_page,
}


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

def _flag(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _rate(cond: str) -> str:
    return f"round(CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*), 4)"


_ALL_TXN = ["id"] + S.V_COLS + ["Amount", "Class"]
_LOG = "(CASE WHEN Amount > -1 THEN ln(1 + Amount) END)"
_BINS = ("CASE WHEN {c} < 50 THEN 'Low' WHEN {c} < 200 THEN 'Medium' "
         "WHEN {c} < 1000 THEN 'High' ELSE 'Very_High' END")

WITH_TXN = f"WITH txn AS ({FX.TXN_SQL}) "
WITH_SILVER = (
    f"WITH txn AS ({FX.TXN_SQL}), "
    "dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _ALL_TXN[1:]) + ") AS rn FROM txn) WHERE rn = 1), "
    "silver AS (SELECT *, " + _LOG + " AS Amount_log, " + _BINS.format(c="Amount") + " AS Amount_category, "
    + ", ".join(f"abs({c}) AS {c}_abs" for c in S.ABS_COLS)
    + ", V1 * V2 AS V1_V2_interaction, V1 * " + _LOG + " AS V1_Amount_interaction, "
    "round(percent_rank() OVER (ORDER BY Amount ASC NULLS FIRST), 4) AS Amount_percentile, "
    "CAST(ntile(4) OVER (ORDER BY Amount ASC NULLS FIRST, id ASC NULLS FIRST) AS INTEGER) AS Amount_quartile "
    "FROM dedup) "
)
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

_SCORE = ("(abs(V1) + abs(V2)) / (1.0 + abs(V1) + abs(V2))")
WITH_SCORED = (WITH_TXN + f", scored AS (SELECT *, {_SCORE} AS score, "
               f"CASE WHEN {_SCORE} > 0.5 THEN 1 ELSE 0 END AS prediction FROM txn) ")
_SCORE_TABLE = (", st AS (SELECT score, " + _flag("Class = 1") + " AS pos, " + _flag("Class <> 1")
                + " AS neg FROM scored GROUP BY score), "
                "r AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
                "AND 1 PRECEDING), 0) AS bpos, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN "
                "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bneg, sum(pos) OVER () AS P, "
                "sum(neg) OVER () AS N FROM st) ")
_RISK = ("CASE WHEN fraud_probability > -0.001 AND fraud_probability <= 0.3 THEN 'Low' "
         "WHEN fraud_probability > 0.3 AND fraud_probability <= 0.7 THEN 'Medium' "
         "WHEN fraud_probability > 0.7 AND fraud_probability <= 1.001 THEN 'High' END")
WITH_FSCORES = (WITH_SCORED + ", fs0 AS (SELECT id, Amount, Class, CAST(prediction AS BIGINT) AS fraud_prediction, "
                "round_even(least(1.0, score * 2.5), 6) AS fraud_probability, 'formula' AS model_name, '1' AS model_version FROM scored), "
                f"fs AS (SELECT *, {_RISK} AS risk_category FROM fs0) ")


def _gold_by_amount_sql() -> str:
    return ("SELECT Amount_category, count(*) AS total_transactions, " + _flag("Class = 1")
            + " AS fraud_count, " + _flag("Class = 0") + " AS legit_count, round(avg(Amount), 2) AS avg_amount, "
            + _rate("Class = 1") + " AS fraud_rate_pct FROM silver GROUP BY Amount_category")


def _gold_by_quartile_sql() -> str:
    return ("SELECT Amount_quartile, count(*) AS total_transactions, " + _flag("Class = 1")
            + " AS fraud_count, round(avg(Amount), 2) AS avg_amount, "
            + _rate("Class = 1") + " AS fraud_rate_pct FROM silver GROUP BY Amount_quartile")


def _kpis_sql() -> str:
    return ("SELECT count(*) AS total_transactions, " + _flag("Class = 1") + " AS total_frauds, "
            + _flag("Class = 0") + " AS total_legit, " + _rate("Class = 1") + " AS overall_fraud_rate, "
            "round(sum(CASE WHEN Class = 1 THEN Amount ELSE 0.0 END), 2) AS total_fraud_amount, "
            "round(avg(Amount), 2) AS avg_transaction_amount FROM silver")


def _masked_corr(x: str, y: str) -> str:
    xv = f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"
    yv = f"(CASE WHEN isnan({y}) THEN NULL ELSE {y} END)"
    xm = f"(CASE WHEN {yv} IS NOT NULL THEN {xv} END)"
    ym = f"(CASE WHEN {xv} IS NOT NULL THEN {yv} END)"
    den = f"(stddev_pop({xm}) * stddev_pop({ym}))"
    return f"(CASE WHEN {den} > 0 THEN covar_pop({xm}, {ym}) / {den} END)"


_UNPIVOT = ("long AS (SELECT id, Class, feature, CAST(value AS DOUBLE) AS value FROM txn "
            "UNPIVOT INCLUDE NULLS (value FOR feature IN (" + ", ".join(CORR_COLS) + "))), "
            "lc AS (SELECT feature, " + _masked_corr("value", "CAST(Class AS DOUBLE)")
            + " AS corr FROM long GROUP BY feature) ")


def _top_sql(k: int) -> str:
    return (WITH_TXN + ", " + _UNPIVOT + f"SELECT feature, round(corr, {ROUND_STAT}) + 0.0 AS corr, "
            f"round(abs(corr), {ROUND_STAT}) AS abs_corr FROM lc ORDER BY abs(corr) DESC NULLS LAST, "
            f"feature LIMIT {k}")


def _corr_matrix_sql() -> str:
    # pairs over the long form: one row per (id, x) joined to one per (id, y)
    return (WITH_TXN + ", " + _UNPIVOT
            + ", top AS (SELECT feature FROM lc ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 10), "
            "sel AS (SELECT feature FROM top UNION ALL SELECT 'Class'), "
            "long2 AS (SELECT id, feature, value FROM long WHERE feature IN (SELECT feature FROM top) "
            "UNION ALL SELECT id, 'Class', CAST(Class AS DOUBLE) FROM txn), "
            "pairs AS (SELECT a.feature AS x, b.feature AS y, a.value AS xv, b.value AS yv "
            "FROM long2 a JOIN long2 b ON a.id = b.id) "
            f"SELECT x, y, round({_masked_corr('xv', 'yv')}, {ROUND_STAT}) + 0.0 AS r FROM pairs GROUP BY x, y")


def _box_sql() -> str:
    q = ("quantile_cont(value, {p})")
    return (WITH_TXN + ", " + _UNPIVOT
            + ", top AS (SELECT feature FROM lc ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 6), "
            "v AS (SELECT feature, Class, value FROM long WHERE feature IN (SELECT feature FROM top) "
            "AND value IS NOT NULL AND NOT isnan(value)), "
            "q AS (SELECT feature, Class, count(*) AS n, " + q.format(p=0.25) + " AS q1, "
            + q.format(p=0.5) + " AS median, " + q.format(p=0.75) + " AS q3 FROM v GROUP BY feature, Class), "
            "w AS (SELECT v.feature, v.Class, min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS whisker_lo, "
            "max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_hi, "
            "count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers, "
            "min(value) AS min, max(value) AS max FROM v JOIN q ON v.feature = q.feature AND v.Class = q.Class "
            "GROUP BY v.feature, v.Class) "
            f"SELECT q.feature, q.Class, q.n, round(q1, {ROUND_STAT}) + 0.0 AS q1, round(median, {ROUND_STAT}) + 0.0 AS median, "
            f"round(q3, {ROUND_STAT}) + 0.0 AS q3, round(q3 - q1, {ROUND_STAT}) + 0.0 AS iqr, whisker_lo, whisker_hi, "
            "outliers, min, max FROM q JOIN w ON q.feature = w.feature AND q.Class = w.Class")


def _box_null_sql() -> str:
    names = ", ".join(NULL_CLASS_COLS)
    return (WITH_TXN + f", v AS (SELECT CASE WHEN id % 5 <> 0 THEN Class END AS Class, feature, value FROM txn UNPIVOT (value FOR feature IN ({names})) "
            "WHERE NOT isnan(value)), q AS (SELECT feature, Class, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
            "quantile_cont(value, 0.75) AS q3, min(value) AS min, max(value) AS max FROM v GROUP BY feature, Class) "
            f"SELECT q.feature, q.Class, n, round(q1, {ROUND_STAT}) + 0.0 AS q1, round(median, {ROUND_STAT}) + 0.0 AS median, "
            f"round(q3, {ROUND_STAT}) + 0.0 AS q3, round(q3 - q1, {ROUND_STAT}) + 0.0 AS iqr, "
            "min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_lo, max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi, "
            "count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers, min, max "
            "FROM q JOIN v ON v.feature = q.feature AND v.Class IS NOT DISTINCT FROM q.Class GROUP BY ALL")


def _permuted_sql() -> str:
    """Places by two hashes; areas from average ranks."""
    own = "SELECT t.Class, '{p}' AS permuted, abs({a}) + abs({b}) AS m FROM take t JOIN give g ON t.place = g.place"
    variants = " UNION ALL ".join(own.format(p=p, a=a, b=b) for p, a, b in (("", "t.V1", "t.V2"), ("V1", "g.V1", "t.V2"), ("V2", "t.V1", "g.V2")))
    return (WITH_TXN + "".join(f", {s} AS (SELECT *, row_number() OVER (ORDER BY md5('{s}:' || id), id) AS place FROM txn)" for s in ("take", "give"))
            + f", x AS (SELECT permuted, Class, m / (1.0 + m) AS score FROM ({variants})), "
            "r AS (SELECT *, rank() OVER (PARTITION BY permuted ORDER BY score) + (count(*) OVER (PARTITION BY permuted, score) - 1) / 2.0::DOUBLE AS r FROM x), "
            "s AS (SELECT permuted, sum(r) FILTER (Class = 1) AS r, count(*) FILTER (Class = 1)::DOUBLE AS p, count(*) FILTER (Class = 0)::DOUBLE AS n "
            f"FROM r GROUP BY permuted) SELECT permuted, round(CASE WHEN p * n > 0 THEN (r - p * (p + 1) / 2) / (p * n) END, {ROUND_METRIC}) AS auc_roc FROM s")


def _root_split_sql() -> str:
    """Gains of every cut of every feature, from running sums of gradients and hessians."""
    names = ", ".join(COARSE)
    gain = "(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2"
    return (WITH_TXN + f", t AS (SELECT Class, {', '.join(f'round({c} * 8) AS {c}' for c in COARSE)} FROM txn), p AS (SELECT avg(Class) AS p FROM t), "
            "v AS (SELECT feature, value + 0.0 AS value, sum(p - Class) AS g, sum(p * (1 - p)) AS h FROM (SELECT * FROM t "
            f"UNPIVOT (value FOR feature IN ({names}))), p GROUP BY ALL), "
            "c AS (SELECT feature, value, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY feature) AS g, "
            "sum(h) OVER (PARTITION BY feature) AS h FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)) "
            f"SELECT feature, value AS border, round({gain}, 6) AS gain, round(-0.1 * gl / (hl + 1), 8) AS left_value, "
            "round(-0.1 * (g - gl) / (h - hl + 1), 8) AS right_value FROM c WHERE hl >= 1 AND h - hl >= 1 "
            f"ORDER BY {gain} DESC, feature, value LIMIT 1")


def _quarantine_sql() -> str:
    reason = ("CASE WHEN o_orderkey % 11 = 0 THEN 'columns' WHEN o_orderkey % 10 = 0 AND o_orderkey % 7 = 0 THEN 'cast: id, price' "
              "WHEN o_orderkey % 10 = 0 THEN 'cast: id' WHEN o_orderkey % 7 = 0 THEN 'cast: price' ELSE 'accepted' END")
    return f"SELECT {reason} AS reason, count(*) AS lines FROM orders GROUP BY ALL"


def _incremental_sql() -> str:
    n = "(SELECT count(*) FILTER (WHERE {c}) FROM embeddings)"
    part, later = "vec_id % 10 <> 0", "vec_id % 10 <> 1"
    runs = [(n.format(c=part), "0", "0", part), ("0", n.format(c=part), "0", part),
            (n.format(c=f"{later} AND (vec_id % 10 = 0 OR vec_id % 7 = 0)"), n.format(c=f"{part} AND {later} AND vec_id % 7 <> 0"),
             n.format(c="vec_id % 10 = 1"), later), (n.format(c=later), "0", "0", later)]
    return " UNION ALL ".join(f"SELECT {i}::INTEGER AS run, {s}::BIGINT AS scored, {k}::BIGINT AS kept, {r}::BIGINT AS removed, {n.format(c=c)} AS rows"
                              for i, (s, k, r, c) in enumerate(runs, 1))


def _hist_sql() -> str:
    """Counts by a range join of the values with each bin's edges."""
    edge = "(CASE WHEN {i} >= 50 THEN hi ELSE CAST({i} AS DOUBLE) * ((hi - lo) / 50.0) + lo END)"
    return (WITH_SILVER + ", long AS (SELECT Class, feature, value FROM silver UNPIVOT (value FOR feature IN "
            "(Amount, Amount_log)) WHERE value IS NOT NULL AND NOT isnan(value)), "
            "ends AS (SELECT Class, feature, min(value) AS mn, max(value) AS mx FROM long GROUP BY Class, feature), "
            "rng AS (SELECT Class, feature, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, "
            "CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM ends), "
            f"grid AS (SELECT Class, feature, CAST(g.bin AS INTEGER) AS bin, {edge.format(i='(g.bin - 1)')} AS b0, "
            f"{edge.format(i='g.bin')} AS b1 FROM rng, range(1, 51) g(bin)) "
            f"SELECT g.Class, g.feature, g.bin, round(g.b0, {ROUND_LOG}) AS bin_lo, round(g.b1, {ROUND_LOG}) AS bin_hi, "
            "count(l.value) AS count FROM grid g LEFT JOIN long l ON l.Class = g.Class AND l.feature = g.feature "
            "AND l.value >= g.b0 AND (l.value < g.b1 OR g.bin = 50) GROUP BY ALL")


def _split_sql(view_sql: str) -> str:
    return (f"WITH t AS ({view_sql}), c AS (SELECT Class, count(*) AS n, "
            "CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) AS k FROM t GROUP BY Class), "
            "s AS (SELECT 'test' AS split, Class, k AS m FROM c UNION ALL SELECT 'train', Class, n - k FROM c) "
            "SELECT split, CAST(sum(m) AS BIGINT) AS records, "
            "CAST(sum(CASE WHEN Class = 1 THEN m ELSE 0 END) AS BIGINT) AS fraud_count, "
            "round(CAST(sum(CASE WHEN Class = 1 THEN m ELSE 0 END) AS DOUBLE) / sum(m) * 100.0, 4) AS fraud_rate_pct "
            "FROM s GROUP BY split")


def _roc_of(score: str) -> str:
    """Points by counting the rows at or above each score; a point in the middle
    of a straight run (same slope to both neighbours' counts) is left out."""
    return (f"(WITH u AS (SELECT {score} AS s, count(*) FILTER (Class = 1) AS p, count(*) FILTER (Class <> 1) AS n "
            "FROM scored GROUP BY ALL), "
            "above AS (SELECT a.s, a.p, a.n, sum(b.p) AS tp, sum(b.n) AS fp FROM u a JOIN u b ON b.s >= a.s GROUP BY ALL), "
            "t AS (SELECT sum(p) AS all_p, sum(n) AS all_n, max(s) AS top, min(s) AS low FROM u), "
            "near AS (SELECT *, lead(p) OVER (ORDER BY s DESC) AS next_p, lead(n) OVER (ORDER BY s DESC) AS next_n FROM above) "
            "SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL "
            f"SELECT CAST(s AS DOUBLE), round(CASE WHEN all_n > 0 THEN CAST(fp AS DOUBLE) / all_n END, {ROUND_METRIC}), "
            f"round(CASE WHEN all_p > 0 THEN CAST(tp AS DOUBLE) / all_p END, {ROUND_METRIC}) FROM near, t "
            "WHERE s = top OR s = low OR next_p <> p OR next_n <> n)")


def _roc_sql() -> str:
    return WITH_SCORED + "SELECT * FROM " + _roc_of("score")


def _roc_by_model_sql() -> str:
    return (WITH_SCORED + "SELECT 'v1_v2' AS model, * FROM " + _roc_of("score")
            + " UNION ALL SELECT 'v3', * FROM " + _roc_of("round(abs(V3), 2)"))


_TIED = "WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, round(o_totalprice / 20000) AS price FROM orders) "


def _holdout_sql() -> str:
    return (f"WITH t AS ({FX.TXN_ML_SQL}), k AS (SELECT id, Amount, Class, row_number() OVER (PARTITION BY Class "
            "ORDER BY md5('42:' || id), id) AS r, count(*) OVER (PARTITION BY Class) AS n FROM t) "
            "SELECT id, Amount, Class, true AS probability_ok, true AS prediction_ok, true AS rounded_ok FROM k "
            "WHERE r <= floor(0.2 * n + 0.5)")


ORACLE: dict[str, str] = {
    "class_balance": WITH_TXN + "SELECT count(*) AS total_records, " + _flag("Class = 1") + " AS fraud_count, "
    + _flag("Class = 0") + " AS legit_count, " + _rate("Class = 1") + " AS fraud_pct FROM txn",
    "label_rate_pct": WITH_TXN + "SELECT round(avg(Class) * 100.0, 4) AS fraud_pct FROM txn",
    "null_counts": WITH_TXN + "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE id % {i + 3} = 0" + ("" if c in ("id", "Class") else " OR id % 11 = 1") + f") AS {c}"
        for i, c in enumerate(_ALL_TXN)) + " FROM txn",
    "duplicate_report": "SELECT count(*) AS total_records, (SELECT count(*) FROM (SELECT DISTINCT "
    "l_orderkey, l_linenumber FROM lineitem)) AS distinct_ids, count(*) - (SELECT count(*) FROM (SELECT "
    "DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates FROM lineitem",
    "dedupe": "SELECT " + ", ".join(_LI_COLS) + " FROM (SELECT *, row_number() OVER (PARTITION BY "
    "l_orderkey, l_linenumber ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in _LI_COLS
                                                      if c not in LINEITEM_KEYS) + ") AS rn FROM lineitem) WHERE rn = 1",
    "quality_summary": WITH_SILVER + "SELECT count(*) AS total_records, count(DISTINCT id) AS unique_ids, "
    + _flag("Class IS NULL") + " AS null_labels, " + _flag("Amount < 0") + " AS negative_amounts, "
    "min(Amount) AS min_amount, max(Amount) AS max_amount, round(avg(Amount), 2) AS avg_amount, "
    + _flag("Class = 1") + " AS fraud_count, " + _flag("Class = 0") + " AS legit_count FROM silver",
    "silver_features": WITH_SILVER + "SELECT * REPLACE (round(Amount_log, 8) AS Amount_log, "
    "round(V1_Amount_interaction, 8) + 0.0 AS V1_Amount_interaction) FROM silver",
    "amount_percentile": WITH_TXN + "SELECT id, Amount, round(percent_rank() OVER (ORDER BY Amount ASC "
    "NULLS FIRST), 4) AS Amount_percentile FROM txn",
    "amount_quartile": WITH_TXN + "SELECT id, Amount, CAST(ntile(4) OVER (ORDER BY Amount ASC NULLS FIRST, "
    "id ASC NULLS FIRST) AS INTEGER) AS Amount_quartile FROM txn",
    "orders_percentile": "SELECT o_orderkey, o_totalprice, round(percent_rank() OVER (ORDER BY o_totalprice "
    "ASC NULLS FIRST), 4) AS price_percentile, CAST(ntile(4) OVER (ORDER BY o_totalprice ASC NULLS FIRST, "
    "o_orderkey ASC NULLS FIRST) AS INTEGER) AS price_quartile FROM orders",
    "fraud_by_amount": WITH_SILVER + _gold_by_amount_sql(),
    "fraud_by_order_price": "WITH o AS (SELECT o_totalprice / 200.0 AS Amount, CASE WHEN o_orderstatus = 'F' "
    "THEN 1 ELSE 0 END AS Class FROM orders), silver AS (SELECT *, " + _BINS.format(c="Amount") + " AS Amount_category FROM o) "
    + _gold_by_amount_sql(),
    "fraud_by_quartile": WITH_SILVER + _gold_by_quartile_sql(),
    "kpis": WITH_SILVER + _kpis_sql(),
    "feature_summary": WITH_SILVER + "SELECT Class, " + ", ".join(
        f"round(avg({c}), 4) AS avg_{c}" for c in S.SUMMARY_COLS) + " FROM silver GROUP BY Class",
    "value_counts": WITH_TXN + "SELECT Class, count(*) AS count FROM txn GROUP BY Class",
    "class_distribution": WITH_TXN + "SELECT Class, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100.0 / "
    "sum(count(*)) OVER (), 4) AS pct FROM txn GROUP BY Class",
    "preview_ordered": WITH_TXN + "SELECT id, Amount, Class FROM txn ORDER BY id LIMIT 1000",
    "histogram_by_class": _hist_sql(),
    "label_correlation": WITH_TXN + ", " + _UNPIVOT + f"SELECT feature, round(corr, {ROUND_STAT}) + 0.0 AS corr FROM lc",
    "top_correlated": _top_sql(10),
    "correlation_matrix": _corr_matrix_sql(),
    "box_stats": _box_sql(),
    "split_report": _split_sql(FX.TXN_ML_SQL),
    "split_report_txn": _split_sql(FX.TXN_SQL),
    "zscore": WITH_TXN + "SELECT id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () "
        f"ELSE 1.0 END, {ROUND_STAT}) + 0.0 AS {c}" for c in CORR_COLS) + " FROM txn",
    "confusion_matrix": WITH_SCORED + "SELECT a AS actual, p AS predicted, CAST(count(s.id) AS BIGINT) AS count "
    "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(a, p) LEFT JOIN scored s ON s.Class = g.a AND "
    "(CASE WHEN s.prediction = 1 THEN 1 ELSE 0 END) = g.p GROUP BY a, p",
    "classification_metrics": WITH_SCORED + ", c AS (SELECT " + _flag("Class = 1 AND prediction = 1") + " AS tp, "
    + _flag("Class = 0 AND prediction = 1") + " AS fp, " + _flag("Class = 1 AND prediction <> 1") + " AS fn, "
    + _flag("Class = 0 AND prediction <> 1") + " AS tn FROM scored) SELECT "
    "CASE WHEN tp + tn + fp + fn > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy, "
    "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, "
    "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall, "
    "CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score, "
    "tp, fp, fn, tn FROM c",
    "auc_roc": WITH_SCORED + _SCORE_TABLE + f"SELECT round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN "
    "sum(pos * (bneg + neg * 0.5)) / (CAST(max(P) AS DOUBLE) * max(N)) END, "
    f"{ROUND_METRIC}) AS auc_roc FROM r",
    "average_precision": WITH_SCORED + _SCORE_TABLE + "SELECT round(CASE WHEN max(P) > 0 THEN coalesce(sum("
    "CASE WHEN pos > 0 THEN pos * (P - bpos) / ((P - bpos) + (N - bneg)) END), 0.0) / max(P) END, "
    f"{ROUND_METRIC}) AS average_precision FROM r",
    "roc_points": _roc_sql(),
    "risk_bands": WITH_FSCORES + "SELECT risk_category, count(*) AS count FROM fs GROUP BY risk_category",
    "scores_page": WITH_FSCORES + "SELECT CAST(id AS BIGINT) AS id, Amount, CAST(Class AS BIGINT) AS Class, "
    "fraud_prediction, fraud_probability, risk_category, model_name, model_version FROM fs WHERE risk_category = 'Medium'",
    "prediction_distribution": WITH_FSCORES + "SELECT fraud_prediction, count(*) AS count FROM fs GROUP BY fraud_prediction",
    "roc_by_model": _roc_by_model_sql(),
    "quartile_string_id": _TIED + "SELECT id, price, CAST(ntile(4) OVER (ORDER BY price, id) AS INTEGER) AS quartile FROM o",
    "percentile_refined": _TIED + "SELECT id, price, 9007199254740992 + CAST(id AS BIGINT) AS big, "
    "round(percent_rank() OVER (ORDER BY id), 4) AS id_rank, round(percent_rank() OVER (ORDER BY CAST(id AS BIGINT)), 4) AS big_rank FROM o",
    "quartile_hot_value": "WITH li AS (SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_orderkey % 3 = 0 THEN 30000.0 "
    "ELSE max(l_extendedprice) END AS price FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT id, price, "
    "CAST(ntile(4) OVER (ORDER BY price, id) AS INTEGER) AS quartile, round(percent_rank() OVER (ORDER BY price), 4) AS percentile FROM li",
    "quality_summary_flags": WITH_TXN + ", d AS (SELECT id, CASE WHEN id % 17 = 0 THEN -Amount ELSE Amount END AS Amount, "
    "CASE WHEN id % 13 <> 0 THEN Class END AS Class FROM txn) SELECT count(*) AS total_records, count(DISTINCT id) AS unique_ids, "
    + _flag("Class IS NULL") + " AS null_labels, " + _flag("Amount < 0") + " AS negative_amounts, "
    "min(Amount) AS min_amount, max(Amount) AS max_amount, round(avg(Amount), 2) AS avg_amount, "
    + _flag("Class = 1") + " AS fraud_count, " + _flag("Class = 0") + " AS legit_count FROM d",
    "split_members": WITH_TXN + ", k AS (SELECT id, Class, row_number() OVER (PARTITION BY Class ORDER BY md5('42:' || id), id) AS r, "
    "count(*) OVER (PARTITION BY Class) AS n FROM txn) SELECT id, Class, CASE WHEN r <= floor(0.2 * n + 0.5) THEN 'test' "
    "ELSE 'train' END AS split FROM k",
    **{f"{k}_scores": _holdout_sql() for k in ("lr", "rf", "gbt")},
    "feature_importance": f"SELECT unnest(['rf', 'gbt']) AS model, CAST({len(S.MODEL_FEATURES)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS negative",
    "compare_models": "SELECT unnest(['LogisticRegression', 'RandomForest', 'GradientBoostedTrees']) AS model_type, true AS metrics_ok, "
    "true AS in_order",
    "best_run": "SELECT CAST(3 AS BIGINT) AS runs, true AS auc_ok",
    "model_performance": f"SELECT '{S.MODEL_NAME}' AS model_name, CAST(1 AS BIGINT) AS model_version, count(*) AS total_scored, true AS flagged_ok, "
    "true AS metrics_ok FROM embeddings",
    "performance_page": f"SELECT '{S.MODEL_NAME}' AS model_name, CAST(1 AS BIGINT) AS model_version, true AS auc_roc_ok, true AS precision_ok, "
    "true AS recall_ok, true AS f1_score_ok",
    "report_by_risk": WITH_FSCORES + "SELECT risk_category, model_name, round(sum(Amount), 2) AS sum_Amount, CAST(sum(fraud_prediction) AS BIGINT) "
    "AS sum_fraud_prediction FROM fs GROUP BY ALL",
    "box_stats_null_class": _box_null_sql(),
    "split_stable": WITH_TXN + "SELECT id, Class, CASE WHEN ('0x' || substr(md5('42:' || id), 1, 8))::BIGINT / 4294967296.0::DOUBLE "
    "< CASE Class WHEN 0 THEN 0.2::DOUBLE WHEN 1 THEN 0.35::DOUBLE ELSE 0 END THEN 'test' ELSE 'train' END AS split FROM txn",
    "quarantine": _quarantine_sql(),
    "incremental_scores": _incremental_sql(),
    "permuted_auc": _permuted_sql(),
    "gbt_root_split": _root_split_sql(),
    "gbt_history": "SELECT CAST(r AS BIGINT) AS round, true AS loss_falls, true AS eval_ok FROM range(1, 301) t(r)",
    "permutation_importance": f"SELECT unnest(['lr', 'rf', 'gbt']) AS model, CAST({len(S.MODEL_FEATURES)} AS BIGINT) AS features, CAST(0 AS BIGINT) AS outside",
    "executive_summary": WITH_SILVER + _kpis_sql(),
    "fraud_analysis": WITH_SILVER + ", a AS (" + _gold_by_amount_sql() + "), q AS (" + _gold_by_quartile_sql()
    + ") SELECT 'amount_category' AS dimension, Amount_category AS bucket, total_transactions, fraud_count, "
    "fraud_rate_pct FROM a UNION ALL SELECT 'amount_quartile', CAST(Amount_quartile AS VARCHAR), "
    "total_transactions, fraud_count, fraud_rate_pct FROM q",
    "cast_rejects": "WITH t AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'k' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id, "
    "o_orderpriority AS V1, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS Amount, "
    "o_orderstatus AS Class FROM orders) SELECT " + ", ".join(
        f"CAST(count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {'INTEGER' if c in ('id', 'Class') else 'DOUBLE'}) IS NULL) AS BIGINT) AS {c}"
        for c in ("id", "V1", "Amount", "Class")) + " FROM t",
    "report_aggregate": WITH_SILVER + ", a AS (" + _gold_by_amount_sql() + ") SELECT "
    "CAST(sum(total_transactions) AS BIGINT) AS sum_total_transactions, CAST(sum(fraud_count) AS BIGINT) "
    "AS sum_fraud_count, CAST(sum(legit_count) AS BIGINT) AS sum_legit_count FROM a",
}
