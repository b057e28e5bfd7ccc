"""Stable split, incremental scores, quarantine lane."""
import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwise import schema as S
from ledgerwise.ml import train as TR
from ledgerwise.ml.incremental import score_incremental
from ledgerwise.ml.score import score_rows
from ledgerwise.ml.split_stable import stable_split
from ledgerwise.sources import quarantine as QU
from ledgerwise.sources.lakehouse import Lakehouse


def sides(df, **how):
    return {r.id: r.split for r in stable_split(df, **how).select("id", "split").collect()}


def test_no_row_moves_when_others_come_and_go(spark):
    df = spark.range(3_000).select("id", (F.col("id") % 3 == 0).cast("int").alias("Class"), (F.col("id") % 40).alias("customer"))
    base = sides(df.filter("id < 2700"))
    more = sides(df.filter("id >= 270"))
    assert all(more[i] == s for i, s in base.items() if i in more) and len(set(base) & set(more)) == 2_430
    assert sides(df.filter("id < 2700").repartition(5)) == base
    assert all((s == "test") == (int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) / 2**32 < 0.2) for i, s in base.items())
    n = len(base)
    assert abs(sum(s == "test" for s in base.values()) - 0.2 * n) < 4 * math.sqrt(n * 0.2 * 0.8)


def test_thresholds_by_class_and_whole_groups(spark):
    df = spark.range(4_000).select("id", (F.col("id") % 4).cast("int").alias("Class"), (F.col("id") % 50).alias("customer"))
    df = df.withColumn("Class", F.when(F.col("Class") < 3, F.col("Class")))
    got = stable_split(df, {0: 0.5, 1: 0.1, None: 0.25}).groupBy("Class").agg(F.avg((F.col("split") == "test").cast("int")).alias("share"))
    share = {r.Class: r.share for r in got.collect()}
    for k, p in ((0, 0.5), (1, 0.1), (None, 0.25)):
        assert abs(share[k] - p) < 4 * math.sqrt(p * (1 - p) / 1_000)
    assert share[2] == 0
    each = stable_split(df, 0.3, group="customer").groupBy("customer").agg(F.count_distinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in each)
    with pytest.raises(ValueError):
        stable_split(df, {0: 0.5}, group="customer")
    assert sides(spark.createDataFrame([(None, 1), (3, None)], "id long, Class int"))[None] in ("test", "train")


@pytest.fixture(scope="module")
def scoring(spark):
    df = spark.range(300).select(F.col("id").cast("int").alias("id"), (F.col("id") / 300).alias("a"), F.rand(3).alias("b"),
                                 (F.col("id") * 1.0).alias("Amount"), (F.col("id") % 2).cast("int").alias("Class")).cache()
    return df, TR.fit_pipeline(df, "lr", ["a", "b"], {"max_iter": 5})


def same_as_full(run, model, df, version="1"):
    cols = [c for c in S.SCORES_SCHEMA.names if c != "scored_at"]
    want = score_rows(model, df, "m", version).select(*cols)
    got = run.scores.select(*cols)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_new_and_changed_rows_are_scored(spark, scoring):
    df, model = scoring
    lake = Lakehouse.scratch(spark, "test-inc")
    how = dict(features=["a", "b"], buckets=8)
    go = lambda d, m=model, v="1": score_incremental(lake, m, d, "m", v, **how)
    first = go(df.filter("id < 200"))
    assert (first.scored, first.kept, first.removed) == (200, 0, 0) and same_as_full(first, model, df.filter("id < 200"))
    again = go(df.filter("id < 200"))
    assert (again.scored, again.kept, again.removed, again.buckets) == (0, 200, 0, 0)
    changed = df.filter("id < 250 and id != 7").withColumn("b", F.when(F.col("id") == 5, 0.123).otherwise(F.col("b")))
    third = go(changed)
    assert (third.scored, third.kept, third.removed) == (51, 198, 1) and same_as_full(third, model, changed)
    nulls = changed.withColumn("Class", F.when(F.col("id") != 9, F.col("Class")))
    assert go(nulls).scored == 1
    assert same_as_full(go(nulls, v="2"), model, nulls, "2")
    one = go(nulls.filter("id = 3"), v="2")
    assert (one.scored, one.kept, one.removed) == (0, 1, 248) and same_as_full(one, model, nulls.filter("id = 3"), "2")


def test_empty_input_and_first_run(spark, scoring):
    df, model = scoring
    lake = Lakehouse.scratch(spark, "test-inc")
    run = score_incremental(lake, model, df.limit(0), "m", "1", features=["a", "b"])
    assert run.scored == 0 and run.scores.count() == 0
    assert score_incremental(lake, model, df, "m", "1", features=["a", "b"]).scored == 300


def test_accepted_and_rejected_make_up_what_landed(spark):
    lake = Lakehouse.scratch(spark, "test-lane")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    lines = ["id,x,s", "1,2.5,a", "2,oops,b", "3,1.0", "4,1.0,c,d", "five,bad,e", "", '6,"7.5","q, r"', "7,,", "8,NaN,n", "  ", "99999999999,1,z"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(lake.path("in"))
    got = QU.land(lake, lake.path("in"), schema)
    assert sorted((r.id, str(r.x), r.s) for r in got.accepted.collect()) == [(1, "2.5", "a"), (6, "7.5", "q, r"), (7, "None", None), (8, "nan", "n")]
    rejected = {r.raw: (r.reason, r.file) for r in got.rejected.collect()}
    assert {k: v[0] for k, v in rejected.items()} == {"2,oops,b": "cast: x", "3,1.0": "columns", "4,1.0,c,d": "columns", "five,bad,e": "cast: id, x",
                                                      "99999999999,1,z": "cast: id"}
    assert all("/in/" in f for _, f in rejected.values())
    assert {r.reason: r.lines for r in QU.quarantine_summary(got.rejected).collect()}["columns"] == 2


def test_border_among_many_ids_of_one_key(spark):
    """A key of two values: the border lies among thousands of ids that share one."""
    from ledgerwise.ml import split as SP
    df = spark.range(5_000).select("id", (F.col("id") % 5 == 0).cast("int").alias("Class"))
    got = SP.stratified_split(df, 0.3, key=(F.col("id") % 2).cast("string"))
    test = {r.id for r in got.filter("split = 'test'").collect()}
    want = set()
    for c in (0, 1):
        own = sorted((i for i in range(5_000) if int(i % 5 == 0) == c), key=lambda i: (i % 2, i))
        want |= set(own[:int(0.3 * len(own) + 0.5)])
    assert test == want
    nulls = spark.createDataFrame([(None, 0), (None, 0), (1, 0), (2, 0)], "id int, Class int")
    assert SP.stratified_split(nulls, 0.5, key=F.lit("k")).filter("split = 'test' AND id IS NULL").count() == 2
    with pytest.raises(ValueError, match="unique"):
        SP.stratified_split(nulls, 0.25, key=F.lit("k"))
