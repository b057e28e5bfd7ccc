"""A fingerprint that a third of all rows share: dealt out by a salt, with the same result."""
from pyspark.sql import functions as F

from ledgerwise.llm import simhash_neardup as SH


def rows(spark):
    texts = [(i, "the same copy of a text in every third row" if i % 3 == 0 else f"text number {i * 7919} is quite unlike {i}") for i in range(600)]
    texts += [(0, "another row of the first id"), (None, "the same copy of a text in every third row")]
    return spark.createDataFrame(texts, "doc_id long, text string")


def test_hot_fingerprints_are_salted_without_a_trace(spark, monkeypatch):
    docs = rows(spark)
    got = sorted((tuple(r) for r in SH.near_duplicates(docs).collect()), key=repr)
    monkeypatch.setattr(SH, "HOT_SHARE", 0.5)  # none is hot
    plain = sorted((tuple(r) for r in SH.near_duplicates(docs).collect()), key=repr)
    assert got == plain and len(got) == 602
    hot = next(r for r in got if r[0] == 3)
    assert hot[3] == 0 and sum(r[2] == hot[2] for r in got) == 201


def test_rows_of_a_hot_fingerprint_meet_in_several_tasks(spark):
    each = SH.fingerprints(rows(spark))
    by_fp = each.groupBy("fp").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    spread = SH._spread(each, by_fp)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan
    assert spread.count() == each.count()


def test_no_second_pass_in_python(spark):
    plan = SH.keep_one(rows(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan


def test_keep_one_keeps_one_copy(spark):
    docs = rows(spark)
    kept = SH.keep_one(docs).collect()
    copies = [r.doc_id for r in kept if r.text.startswith("the same copy")]
    assert sorted(copies, key=str) == [0, None] and sum(r.text.startswith("another") for r in kept) == 1
