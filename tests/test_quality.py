import pytest
from pyspark.sql import types as T

from ledgerwise.operators import quality as Q
from ledgerwise.sources.files import cast_rejects, cast_schema


def test_null_audit_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "x double")
    assert Q.null_counts(df).first().x == 2


def test_duplicate_report_counts_null_key_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    r = Q.duplicate_report(df).first()
    assert (r.total_records, r.distinct_ids, r.duplicates) == (5, 3, 2)


def test_dedupe_keeps_smallest_row(spark):
    df = spark.createDataFrame([(1, 5.0, "b"), (1, 2.0, "z"), (1, 2.0, "a"), (2, None, "q"), (2, 1.0, "p"),
                                (None, 1.0, "x"), (None, 0.5, "y")], "id int, v double, s string")
    got = sorted(Q.dedupe(df, ["id"]).collect(), key=lambda r: (r.id is not None, r.id or 0))
    assert [tuple(r) for r in got] == [(None, 0.5, "y"), (1, 2.0, "a"), (2, None, "q")]
    assert Q.dedupe(df, ["id"]).columns == df.columns


def _summary(spark, rows):
    df = spark.createDataFrame(rows, "id int, Amount double, Class int")
    return Q.quality_summary(df)


@pytest.mark.parametrize("rows", [
    [(1, 1.0, None), (2, 2.0, 0)],          # null label
    [(1, -1.0, 1), (2, 2.0, 0)],            # negative amount
    [(1, 1.0, 1), (1, 2.0, 0)],             # duplicate id
    [],                                      # empty table
])
def test_quality_gate_fails(spark, rows):
    with pytest.raises(Q.QualityGateError):
        Q.assert_quality(_summary(spark, rows))


def test_quality_gate_passes(spark):
    row = Q.assert_quality(_summary(spark, [(1, 1.0, 1), (2, 2.0, 0)]))
    assert row["fraud_count"] == 1 and row["legit_count"] == 1 and row["avg_amount"] == 1.5


def test_cast_rejects_and_strict(spark):
    df = spark.createDataFrame([("x", 1), ("2.5", 3_000_000_000)], "V1 string, id long")
    types = {"V1": T.DoubleType(), "id": T.IntegerType()}
    r = cast_rejects(df, types).first()
    assert (r.V1, r.id) == (1, 1)
    out = cast_schema(df, types).collect()
    assert out[0].V1 is None and out[1].id is None
    with pytest.raises(Exception):
        cast_schema(df, types, strict=True).collect()


def test_null_ids_collapse_then_gate_fires(spark):
    df = spark.createDataFrame([(None, 1.0, 0), (None, 2.0, 1), (1, 3.0, 0)], "id int, Amount double, Class int")
    d = Q.dedupe(df, ["id"])
    assert d.count() == 2
    s = Q.quality_summary(d).first()
    assert (s.total_records, s.unique_ids) == (2, 1)
    with pytest.raises(Q.QualityGateError):
        Q.assert_quality(s.asDict())
