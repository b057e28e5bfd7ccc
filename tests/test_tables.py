"""Tables that stay whole: audited writes, version claims, bucketed tables."""
import threading

import pytest
from pyspark.sql import functions as F

from ledgerwise import schema as S
from ledgerwise.ml.registry import Tracker
from ledgerwise.operators import quality as Q
from ledgerwise.plans import medallion as MD
from ledgerwise.sources.lakehouse import Lakehouse


def bronze(spark, n, amount="abs(id) * 1.0", ids="int"):
    v = [F.lit(0.5).alias(c) for c in S.V_COLS]
    return spark.range(n).selectExpr("cast(id as int) as id").select(
        F.col("id").cast(ids), *v, F.expr(amount).cast("double").alias("Amount"), (F.col("id") % 2).cast("int").alias("Class"))


def test_failing_rows_leave_the_table_alone(spark):
    lake = Lakehouse.scratch(spark, "test-audit")
    assert MD.build_silver(lake, bronze(spark, 20)).count() == 20
    before = {tuple(r) for r in lake.read(S.SILVER).drop("silver_processed_at").collect()}
    for bad in (bronze(spark, 30, "if(id % 5 = 0, -1.0, 1.0)"), bronze(spark, 0),
                bronze(spark, 9).withColumn("Class", F.when(F.col("id") != 3, F.col("Class")))):
        with pytest.raises(Q.QualityGateError):
            MD.build_silver(lake, bad)
        assert {tuple(r) for r in lake.read(S.SILVER).drop("silver_processed_at").collect()} == before
    assert MD.build_silver(lake, bronze(spark, 25)).count() == 25
    assert not lake._fs(lake.path("_staged"))[1].listStatus(lake._fs(lake.path("_staged"))[0])


def test_ids_that_a_cast_makes_equal_fail(spark):
    lake = Lakehouse.scratch(spark, "test-audit")
    texts = bronze(spark, 10, ids="string")
    assert MD.build_silver(lake, texts).count() == 10
    with pytest.raises(Q.QualityGateError, match="duplicate ids"):
        MD.build_silver(lake, texts.unionByName(texts.filter("id = '3'").withColumn("id", F.lit("03"))))
    assert lake.read(S.SILVER).count() == 10


def test_checks_of_distinct_ids_equal_the_summary(spark):
    df = bronze(spark, 50, "if(id % 7 = 0, -id, id)")
    assert df.agg(*Q.quality_checks(unique=True)).first() == Q.quality_summary(df).first()


def test_two_registrations_at_once_get_two_versions(spark):
    lake = Lakehouse.scratch(spark, "test-claims")
    row = ("r1", S.EXPERIMENT_NAME, "run", None, {"model_type": "x"}, {"auc_roc": 0.5}, "/nowhere")
    lake.write(spark.createDataFrame([row], S.RUNS_SCHEMA), S.RUNS)
    trackers, got = [Tracker(lake) for _ in range(4)], []
    start = threading.Barrier(4)

    def register(t):
        start.wait()
        got.append(t.register_best()["version"])

    threads = [threading.Thread(target=register, args=(t,)) for t in trackers]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r.version for r in trackers[0].versions().collect()) == [1, 2, 3, 4]
    assert trackers[0].register_best("other")["version"] == 1
    assert not lake.claim(f"{S.MODEL_NAME}/4") and lake.claim(f"{S.MODEL_NAME}/5")


def test_bucketed_tables_join_and_group_without_moving_rows(spark):
    lake = Lakehouse(spark, "default", catalog=True)
    spark.sql("DROP TABLE IF EXISTS t_left")
    spark.sql("DROP TABLE IF EXISTS t_right")
    a = lake.write_bucketed(bronze(spark, 500), "t_left", ["id"], 4)
    b = lake.write_bucketed(bronze(spark, 300).select("id", F.lit("x").alias("x")), "t_right", ["id"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (a.join(b, "id"), a.join(b, "id", "left_anti"), Q.dedupe(a, ["id"])):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert a.join(b, "id").count() == 300 and Q.dedupe(a, ["id"]).count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE t_left")
        spark.sql("DROP TABLE t_right")


def test_ntile_with_nan_tiebreaks(spark):
    from ledgerwise.operators import ranks as R
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0), (1.0, nan), (2.0, nan), (2.0, None)], "v double, t double")
    got = sorted((r.v, str(r.t), r.q) for r in R.with_ntile(df, "v", 2, "t", "q").collect())
    assert got == [(1.0, "1.0", 1), (1.0, "nan", 1), (2.0, "None", 2), (2.0, "nan", 2)]
    with pytest.raises(ValueError, match="tell rows apart"):
        R.with_ntile(spark.createDataFrame([(1.0, nan)] * 4, "v double, t double"), "v", 2, "t", "q").collect()


def test_scopes_of_threads_are_apart(spark):
    from ledgerwise.session import materialize, stage_scope
    kept = []
    with stage_scope(spark):
        t = threading.Thread(target=lambda: kept.append(materialize(spark.range(3), "other-thread")))
        t.start()
        t.join()
    assert kept[0].count() == 3
