"""The registered corpus queries: contract columns, one row per document, and their SQL."""
import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
PER_DOCUMENT = {
    "op1_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op3_quality_lines": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                          "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4_simhash_neardup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op10_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op11_importance_resample": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op12_lm_scores": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
                       "base_score": "double", "score": "double"},
    "op13_token_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
                             "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
}
WITH_SQL = ["op1_substring_dedup", "op2_url_lists", "op5_warc_derivatives", "op8_poisson_mix", "op9_decontaminate", "op10_line_dedup",
            "op11_importance_resample"]


def test_one_query_for_each_operator():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_contract_columns_and_rows(spark, name):
    out = entry.queries()[name](spark, D)
    types = dict(out.dtypes)
    assert PER_DOCUMENT[name].items() <= types.items()
    docs = spark.read.parquet(f"{D}/documents.parquet")
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    want = con.sql(entry.oracle_sql()[name])
    out = entry.queries()[name](spark, D)
    cols = sorted(out.columns)
    assert sorted(want.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)
    rows = sorted((tuple(dict(zip(want.columns, r))[c] for c in cols) for r in want.fetchall()), key=repr)
    assert got == rows and got
