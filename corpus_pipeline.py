"""The corpus pipeline: stages over the documents table, each by one operator.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and its decisions take effect. All but the last return the columns of documents;
the last adds the copy number and the shuffle key of each copy. ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwise.llm import decontaminate, line_dedup, mixing, quality_lines, simhash_neardup
from ledgerwise.session import materialize


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the line labels reject go."""
    model = quality_lines.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_lines.keep_good(docs, model)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, n_chars follows its text."""
    return line_dedup.dedup_documents(docs, min_chars=40, min_docs=5)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the smallest id."""
    return simhash_neardup.keep_one(docs, shingle=3, max_bits=2)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_similarity=0.8)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, sources mixed to the square roots of their shares."""
    return mixing.poisson_mix(docs, mixing.square_root_weights(docs.select("source")), seed=11)


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_line_dedup),
    ("simhash_neardup", stage_simhash),
    ("decontamination", stage_decontaminate),
    ("mixing", stage_mixing),
]

#: SQL can't express the line labels; tests/llm/test_corpus_pipeline.py has the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
