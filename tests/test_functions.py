import math

from pyspark.sql import functions as F

from ledgerwise import schema as S
from ledgerwise.functions import columns as C

NAN = float("nan")


def test_amount_bins_edges(spark):
    vals = [-1.0, 0.0, 49.999, 50.0, 199.99, 200.0, 999.99, 1000.0, None, NAN]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, a double")
    got = [r.c for r in df.select("i", C.left_closed_bins("a", S.AMOUNT_EDGES, S.AMOUNT_LABELS).alias("c"))
           .orderBy("i").collect()]
    assert got == ["Low", "Low", "Low", "Medium", "Medium", "High", "High",
                   "Very_High", "Very_High", "Very_High"]


def test_log1p_edges(spark):
    df = spark.createDataFrame([(0, -2.0), (1, -1.0), (2, 0.0), (3, None), (4, NAN)], "i int, a double")
    got = [r.l for r in df.select("i", C.log1p("a").alias("l")).orderBy("i").collect()]
    assert got[0] is None and got[1] is None and got[2] == 0.0 and got[3] is None and math.isnan(got[4])


def test_risk_bands(spark):
    vals = [0.0, 0.3, 0.300001, 0.7, 0.700001, 1.0, NAN, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, p double")
    got = [r.c for r in df.select("i", C.right_closed_bins("p", S.RISK_EDGES, S.RISK_LABELS).alias("c"))
           .orderBy("i").collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", None, None]


def test_rate_pct_zero_denominator(spark):
    df = spark.range(1).select(C.rate_pct(F.lit(1), F.lit(0)).alias("r"))
    assert df.first().r is None
