"""Texts that are not valid UTF-8 (a binary column cast to string) stop no operator."""
from pyspark.sql import functions as F

from ledgerwise.llm import decontaminate as DC
from ledgerwise.llm import line_dedup as LD
from ledgerwise.llm import quality_lines as QL
from ledgerwise.llm import simhash_neardup as SH
from ledgerwise.llm import substring_dedup as SD
from ledgerwise.llm import token_counts as TC


def test_invalid_utf8(spark):
    bad = F.concat(F.unhex(F.lit("ff6120fe")), F.repeat(F.lit(" a b c"), 30).cast("binary")).cast("string")
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, bad).otherwise(F.lit("fine text")).alias("text"))
    bench = spark.createDataFrame([(1, "a b c a b c a b c")], "item_id long, text string")
    assert [r.n_words for r in SD.substring_dedup(docs, 10, 4).orderBy("doc_id").collect()] == [2, 92, 92]
    assert TC.token_counts(docs, "word_bpe_49k.json").filter("n_tokens > 0").count() == 3
    assert SH.near_duplicates(docs).filter("component_id = 1").count() == 2
    assert QL.quality_rules(docs).count() == 3
    assert LD.drop_repeated_lines(docs, min_docs=2).filter("n_dropped = 1").count() == 1
    assert {r.doc_id for r in DC.leaks(docs, bench).collect()} == {1, 2}
