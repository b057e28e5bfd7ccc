"""Catalog sinks and scans, SQL surface, shape reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> DataFrame:
    """Full-replace managed table; returns a scan of the written table so that
    later counts and reports read the result instead of rerunning the plan."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def preview(spark: SparkSession, name: str, n: int = 1000, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows of a table; with ``order_by`` a deterministic top-n
    (planned as TakeOrderedAndProject, no full sort)."""
    df = spark.table(name)
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def describe_shape(df: DataFrame) -> DataFrame:
    """One row: row count, column count, column names, schema as DDL."""
    spark = df.sparkSession
    n = df.count()
    schema = T.StructType([
        T.StructField("row_count", T.LongType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("schema_ddl", T.StringType()),
    ])
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return spark.createDataFrame([(n, len(df.columns), list(df.columns), ddl)], schema)


def new_columns(before: DataFrame | list[str], after: DataFrame | list[str]) -> list[str]:
    """Names a stage added, in the order of ``after``."""
    b = before.columns if isinstance(before, DataFrame) else before
    a = after.columns if isinstance(after, DataFrame) else after
    seen = set(b)
    return [c for c in a if c not in seen]


def show(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    df.show(n, truncate=truncate)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)
