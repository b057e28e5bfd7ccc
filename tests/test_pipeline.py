import os

import pytest
from pyspark.sql import functions as F

from ledgerwise import schema as S
from ledgerwise.plans import medallion as MD
from ledgerwise.plans import reports as RP
from ledgerwise.session import checkpoint_dir
from ledgerwise.sources import fixtures as FX
from ledgerwise.sources.files import file_inventory, read_raw
from ledgerwise.sources.lakehouse import Lakehouse
from ledgerwise.streaming.ingest import ingest_landed

SF = "/root/testdata/sf0.001"


def _write_csv(spark, df, path):
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def test_medallion_end_to_end(spark):
    lake = Lakehouse.scratch(spark, "test-lake")
    raw_dir = lake.path("landing")
    _write_csv(spark, FX.txn_ml(spark, SF), raw_dir)
    raw = read_raw(spark, raw_dir)
    assert raw.count() == 500
    res = MD.run_medallion(spark, raw, "unit_test", raw_dir, lake, kinds=("lr", "rf"),
                           params={"rf": {"n_estimators": 10, "max_depth": 4}})
    assert res.silver.count() == 500
    assert len(res.silver.columns) == 43
    tot = res.gold[S.GOLD_BY_AMOUNT].agg(F.sum("total_transactions")).first()[0]
    assert tot == res.gold[S.GOLD_KPIS].first().total_transactions == 500
    q = res.gold[S.GOLD_BY_QUARTILE].orderBy("Amount_quartile").collect()
    assert [r.total_transactions for r in q] == [125, 125, 125, 125]
    sc = res.scores
    assert sc.count() == 500 and set(sc.columns) == set(S.SCORES_SCHEMA.names)
    perf = res.performance.first()
    assert perf.total_scored == 500 and perf.model_version == 1
    used = sc.select("model_name", "model_version").distinct().collect()
    assert [(r.model_name, r.model_version) for r in used] == [(S.MODEL_NAME, "1")]
    run_id = res.runs[1].run_id
    from ledgerwise.ml.registry import Tracker
    cm = Tracker(lake).artifact(run_id, "confusion_matrix").collect()
    assert len(cm) == 4
    assert Tracker(lake).artifact(run_id, "feature_importance").count() == len(S.MODEL_FEATURES)
    # scoring with the scaler refitted on the scored rows (the reference's mode)
    from ledgerwise.ml.score import score_rows
    model, _ = Tracker(lake).load(S.MODEL_NAME, 1)
    refit = score_rows(model, res.silver, S.MODEL_NAME, "1", scaler="refit")
    p = refit.agg(F.count("*").alias("n"), F.min("fraud_probability").alias("lo"),
                  F.max("fraud_probability").alias("hi")).first()
    assert p.n == 500 and 0.0 <= p.lo <= p.hi <= 1.0
    # the job publishes all five views, the curves of each model and the distributions
    assert set(res.views) == set(RP.VIEW_TYPES)
    assert dict(res.views[S.GOLD_SCORES].dtypes)["id"] == "bigint"
    assert spark.sql(f"select count(*) from {S.GOLD_SCORES}").first()[0] == 500
    assert {r.model for r in res.roc.select("model").distinct().collect()} == {"lr", "rf"}
    assert sum(r["count"] for r in res.risk_distribution.collect()) == 500
    assert sum(r["count"] for r in res.prediction_distribution.collect()) == 500
    # and leaves no intermediate table behind
    stage = checkpoint_dir(spark).removeprefix("file:") + "/ledgerwise-stage"
    left = {p.split("-")[0] for p in os.listdir(stage)} if os.path.isdir(stage) else set()
    assert not left & {"silver", "split", "scored"}


def test_silver_is_deterministic(spark):
    b = MD.add_provenance(FX.txn(spark, SF), "unit_test", SF)
    cols = MD.silver_frame(b, stamp=False).columns
    a = MD.silver_frame(b, stamp=False).select(*cols)
    c = MD.silver_frame(b.repartition(7), stamp=False).select(*cols)
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_stream_ingest_takes_each_file_once(spark):
    lake = Lakehouse.scratch(spark, "test-stream")
    land = lake.path("landing")
    t = FX.txn_ml(spark, SF)
    _write_csv(spark, t.filter("id < 200"), land + "/a")
    bronze = lake.path("bronze")
    ck = lake.path("ck")
    ingest_landed(spark, land + "/*", bronze, "unit_test", land, checkpoint=ck)
    assert spark.read.parquet(bronze).count() == 200
    _write_csv(spark, t.filter("id >= 200"), land + "/b")
    ingest_landed(spark, land + "/*", bronze, "unit_test", land, checkpoint=ck)
    got = spark.read.parquet(bronze)
    assert got.count() == 500 and got.select("id").distinct().count() == 500
    assert set(S.PROVENANCE_COLS) <= set(got.columns)


def test_stream_ingest_keeps_its_place_without_a_given_checkpoint(spark):
    lake = Lakehouse.scratch(spark, "test-stream")
    land, bronze = lake.path("landing"), lake.path("bronze")
    t = FX.txn_ml(spark, SF)
    for part, rows in (("a", t.filter("id < 50")), ("b", t.filter("id >= 50"))):
        _write_csv(spark, rows, f"{land}/{part}")
        ingest_landed(spark, land + "/*", bronze, "unit_test", land)
    got = spark.read.parquet(bronze)
    assert got.count() == 500 and got.select("id").distinct().count() == 500


def test_typed_view_raises_on_a_missing_column(spark):
    df = spark.createDataFrame([("Low",)], "Amount_category string")
    with pytest.raises(ValueError, match="total_transactions"):
        RP.typed_view(df, S.GOLD_BY_AMOUNT)


def test_exists_tells_absent_from_unreadable(spark):
    lake = Lakehouse.scratch(spark, "test-exists")
    assert not lake.exists("t")
    spark.createDataFrame([("x",)], "v string").write.text(lake.path("t"))
    assert lake.exists("t")  # there, though no parquet table


def test_no_shared_folder_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_stage_scope_removes_its_tables(spark):
    from ledgerwise.session import materialize, stage_scope
    with stage_scope(spark):
        df = materialize(spark.range(5), "scoped")
        path = df.inputFiles()[0]
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def test_scoring_and_correlations_start_no_job_before_an_action(spark):
    from ledgerwise.operators import profile as P
    li = spark.read.parquet(f"{SF}/lineitem.parquet").groupBy("l_orderkey").agg(F.max("l_tax").alias("a"), F.max("l_discount").alias("b"))
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "planning")
    P.pair_correlations(li, [("a", "b")])
    P.correlation_matrix(li, ["a", "b"])
    assert len(sc.statusTracker().getJobIdsForGroup("plan-only")) == 0
    sc.setJobGroup("", "")


def test_profile_does_not_expand_rows(spark):
    from ledgerwise.operators import profile as P
    t = FX.txn_ml(spark, SF)
    plan = P.correlation_matrix(t, ["V1", "V2", "Amount"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan[plan.rindex("HashAggregate"):]  # nothing below the row aggregate


def test_file_inventory(spark):
    rows = {r.file_name: r.size_bytes for r in file_inventory(spark, SF, "*.parquet").collect()}
    assert rows["events.parquet"] == os.path.getsize(os.path.join(SF, "events.parquet"))
