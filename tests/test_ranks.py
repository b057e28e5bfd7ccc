import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwise.operators import ranks as R
from ledgerwise.session import materialize

NAN = float("nan")


def ntile_window(df, value, k, tiebreak, out):
    return df.withColumn(out, F.ntile(k).over(Window.orderBy(F.col(value).asc_nulls_first(), F.col(tiebreak).asc_nulls_first())))


def percent_rank_window(df, value, out):
    return df.withColumn(out, F.round(F.percent_rank().over(Window.orderBy(F.col(value).asc_nulls_first())), 4))


def _both(df, value="v", tiebreak="id", **search):
    """Rows with the tile and rank of the plain windows and of the forms under test."""
    a = percent_rank_window(ntile_window(df, value, 4, tiebreak, "w"), value, "pw")
    b = R.with_percent_rank(R.with_ntile(df, value, 4, tiebreak, "d", **search), value, "pd",
                            partitions=search.get("partitions"))
    return a.join(b.select(tiebreak, "d", "pd"), tiebreak)


@pytest.mark.parametrize("vals", [
    [1.0],
    [2.0, 1.0],
    [3.0, 1.0, 2.0],
    [5.0, 1.0, 4.0, 2.0, 3.0],
    [7.0] * 9,                                   # all ties
    [None, 1.0, None, 2.0, 2.0, NAN, 0.5, NAN],  # nulls and NaN
    [None, None, None],
    [NAN, NAN, 0.0, -0.0],
])
def test_forms_equal_windows(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    for r in _both(df).collect():
        assert r.w == r.d
        assert r.pw == r.pd


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert R.with_ntile(R.with_percent_rank(df, "v", "p"), "v", 4, "id", "t").collect() == []


@pytest.mark.parametrize("search", [
    dict(grid=2, sample_rows=20, partitions=1),
    dict(grid=8, sample_rows=300, partitions=13),
    dict(),
])
def test_slices_and_ranges_on_orders(spark, search):
    """A third of the rows on one value; few candidates leave large slices,
    many ranges give many offsets."""
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(5.0))
        .when(F.col("o_orderkey") % 17 == 0, F.lit(None))
        .when(F.col("o_orderkey") % 19 == 0, F.lit(NAN))
        .otherwise(F.round(F.col("o_totalprice") / 50)).alias("v")).cache()
    j = _both(o, **search)
    bad = j.filter((F.col("w") != F.col("d")) | ~F.col("pw").eqNullSafe(F.col("pd"))).count()
    assert j.count() == o.count() and bad == 0


def test_string_ids_at_size(spark):
    """One value, ids as digit strings and as words: tiles are equal in size
    and follow the string order (a numeric order of the ids would not)."""
    for pattern in ("%d", "u%07d"):
        df = materialize(spark.range(200_000).select(F.format_string(pattern, "id").alias("id"), F.lit(1.5).alias("v")), "ids")
        got = df.transform(lambda x: R.with_ntile(x, "v", 4, "id", "t"))
        rows = {r.t: (r.n, r.lo, r.hi) for r in got.groupBy("t").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
        assert [rows[t][0] for t in (1, 2, 3, 4)] == [50_000] * 4
        assert all(rows[t][2] < rows[t + 1][1] for t in (1, 2, 3))


def test_longs_beyond_double_precision(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big,)] * 50 + [(big + 2,)] * 3 + [(big - 1,)], "v long")
    got = R.order_statistics(df, "v", {(): [1, 2, 30, 51, 52, 54, 55]}, grid=2, sample_rows=3)
    assert got[(), 1] == (big - 1, 0, 1) and got[(), 2] == (big, 1, 50) and got[(), 30] == (big, 1, 50)
    assert got[(), 51] == (big, 1, 50) and got[(), 52] == (big + 2, 51, 3) and got[(), 54] == (big + 2, 51, 3)
    assert got[(), 55] == (None, None, 0)


@pytest.mark.parametrize("kind", ["int", "decimal(12,3)", "date", "timestamp", "string", "float"])
def test_order_statistics_in_the_columns_own_type(spark, kind):
    raw = [(i * 7919) % 1000 for i in range(600)]
    df = spark.createDataFrame([(x,) for x in raw], "x int")
    col = {"date": F.expr("date_add(date'2001-01-01', x)"), "timestamp": F.expr("timestamp_seconds(x) + interval 5 microseconds"),
           "string": F.concat(F.lit('q"é\\'), F.col("x").cast("string"))}.get(kind, F.col("x").cast(kind))
    df = df.select(col.alias("v"))
    want = sorted(r.v for r in df.collect())
    got = R.order_statistics(df, "v", {(): [1, 100, 333, 600]}, grid=4, sample_rows=50)
    for p in (1, 100, 333, 600):
        v, before, ties = got[(), p]
        assert v == want[p - 1] and before == sum(x < v for x in want) and ties == sum(x == v for x in want)


def test_tiebreak_must_tell_rows_apart(spark):
    df = spark.createDataFrame([(1.0, 7)] * 8, "v double, id int")
    with pytest.raises(ValueError, match="tiebreak"):
        R.with_ntile(df, "v", 4, "id", "t")
    # rows that share a key inside one tile are fine
    ok = spark.createDataFrame([(1.0, 1), (1.0, 1), (1.0, 2), (1.0, 2)], "v double, id int")
    got = sorted((r.id, r.t) for r in R.with_ntile(ok, "v", 2, "id", "t").collect())
    assert got == [(1, 1), (1, 1), (2, 2), (2, 2)]
    nulls = spark.createDataFrame([(1.0, None)] * 4, "v double, id int")
    with pytest.raises(ValueError):
        R.with_ntile(nulls, "v", 4, "id", "t")


def test_order_statistics_groups(spark):
    df = spark.createDataFrame([(g, float(v)) for g in ("a", "b", None) for v in range(10 if g == "a" else 3)],
                               "g string, v double")
    got = R.order_statistics(df, "v", {("a",): [1, 5, 10, 11], ("b",): [2], (None,): [3]}, group_cols=["g"], grid=2, sample_rows=5)
    assert got[("a",), 1] == (0.0, 0, 1)
    assert got[("a",), 5] == (4.0, 4, 1)
    assert got[("a",), 10] == (9.0, 9, 1)
    assert got[("a",), 11] == (None, None, 0)
    assert got[("b",), 2] == (1.0, 1, 1)
    assert got[(None,), 3] == (2.0, 2, 1)


def test_prefix_sums_ranges(spark):
    t = spark.createDataFrame([(float(k), 1) for k in range(100)], "k double, c int")
    out = R.prefix_sums(t, "k", ["c"], with_prev=True, with_totals=True, partitions=10).collect()
    assert len(out) == 100
    for r in out:
        assert r["_before_c"] == int(r.k)
        assert r["_total_c"] == 100
        assert r["_prev_c"] == (None if r.k == 0 else 1)


def test_percent_rank_is_a_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = R.with_percent_rank(df, "o_totalprice", "p")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_box_stats_match_numpy(spark):
    from ledgerwise.operators import profile as P
    rng = np.random.default_rng(3)
    rows = [(int(c), float(v)) for c, v in zip(rng.integers(0, 2, 2000), np.round(rng.normal(0, 1, 2000), 2))]
    df = spark.createDataFrame(rows, "Class int, x double")
    got = {r.Class: r for r in P.box_stats(df, ["x"], "Class").collect()}
    for c in (0, 1):
        vals = np.array([v for k, v in rows if k == c])
        q1, med, q3 = np.percentile(vals, [25, 50, 75])
        assert (got[c].q1, got[c].median, got[c].q3) == (q1, med, q3)


def test_split_exact_sizes(spark):
    from ledgerwise.ml import split
    df = spark.range(3000).select(F.col("id").cast("int").alias("id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("Class"))
    s = split.stratified_split(df, 0.2, 7)
    got = {(r.split, r.Class): r["count"] for r in s.groupBy("split", "Class").count().collect()}
    assert got[("test", 1)] == 200 and got[("test", 0)] == 400
    assert got[("train", 1)] == 800 and got[("train", 0)] == 1600


def test_split_of_repeated_ids(spark):
    from ledgerwise.ml import split
    same = spark.createDataFrame([(5, 1)] * 10, "id int, Class int")
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(same, 0.2)
    # a key shared by several ids is resolved by id
    df = spark.createDataFrame([(i, 1) for i in range(10)], "id int, Class int")
    s = split.stratified_split(df, 0.3, key=F.lit("same"))
    assert sorted(r.id for r in s.filter("split = 'test'").collect()) == [0, 1, 2]


def test_skewed_600k_rows_equal_windows(spark):
    # a third of the rows on one value, plus nulls
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_extendedprice", "l_orderkey")
    li = li.dropDuplicates(["id"]).select(
        "id", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1000.0))
        .when(F.col("l_orderkey") % 101 == 0, F.lit(None))
        .otherwise(F.col("l_extendedprice")).alias("v"))
    li = materialize(li, "skew-test")
    j = _both(li)
    bad = j.filter((F.col("w") != F.col("d")) | ~F.col("pw").eqNullSafe(F.col("pd"))).count()
    assert j.count() == li.count() and bad == 0


def test_tiles_read_off_the_ranked_table(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(5.0)).when(F.col("o_orderkey") % 4 == 1, F.lit(None))
        .when(F.col("o_orderkey") % 5 == 1, F.lit(NAN)).otherwise(F.round(F.col("o_totalprice") / 500)).alias("v")).cache()
    ranked = R.ranked_values(o, "v", partitions=7)
    got = ntile_window(o, "v", 9, "id", "w").withColumn("d", R.ntile_column(o, "v", 9, "id", ranked=ranked))
    assert got.filter("w <> d").count() == 0 and got.select("d").distinct().count() == 9
