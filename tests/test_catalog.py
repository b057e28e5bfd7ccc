from ledgerwise.sources import catalog as C


def test_shape_preview_sql_and_columns(spark):
    df = spark.range(50).selectExpr("cast(id as int) as id", "cast(id * 2 as double) as Amount")
    df.createOrReplaceTempView("t_shape")
    r = C.describe_shape(df).first()
    assert (r.row_count, r.column_count, list(r.columns)) == (50, 2, ["id", "Amount"])
    assert r.schema_ddl == "id int, Amount double"
    p = C.preview(spark, "t_shape", 5, order_by=["id"]).collect()
    assert [x.id for x in p] == [0, 1, 2, 3, 4]
    assert C.sql(spark, "select count(*) as n from t_shape").first().n == 50
    after = df.withColumn("x", df.id + 1)
    assert C.new_columns(df, after) == ["x"]
    assert C.drop_columns(after, ["x", "source_file"]).columns == ["id", "Amount"]


def test_read_path_and_inferred_csv(spark):
    from ledgerwise.sources.files import read_path, read_raw
    from ledgerwise.sources.lakehouse import Lakehouse
    lake = Lakehouse.scratch(spark, "test-io")
    df = spark.range(10).selectExpr("cast(id as int) as id", "cast(id as double) / 4 as Amount")
    lake.write(df, "t")
    assert read_path(spark, lake.path("t")).count() == 10
    df.coalesce(1).write.option("header", "true").csv(lake.path("csv"))
    inferred = read_raw(spark, lake.path("csv"), infer=True)
    assert dict(inferred.dtypes) == {"id": "int", "Amount": "double"}


def test_catalog_tables_round_trip(spark):
    import uuid
    from ledgerwise.sources.lakehouse import Lakehouse
    name = f"lw_test_{uuid.uuid4().hex[:8]}"
    lake = Lakehouse(spark, root="", catalog=True)
    df = spark.range(7).selectExpr("cast(id as int) as id")
    try:
        got = lake.write(df, name)
        assert got.count() == 7 and lake.exists(name)
        assert C.write_table(df, name, mode="append").count() == 14
        assert C.read_table(spark, name).count() == 14
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not lake.exists(name)


def test_show_prints_rows(spark, capsys):
    C.show(spark.range(3).selectExpr("id", "concat('a long value number ', id) as v"), 2)
    out = capsys.readouterr().out
    assert "a long value number 1" in out and "number 2" not in out and "only showing top 2 rows" in out
