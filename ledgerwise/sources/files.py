"""File sources and sinks: raw CSV, landed-file inventory, artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.columns import flag


def read_raw(spark: SparkSession, path: str, schema: T.StructType | None = S.RAW_SCHEMA,
             infer: bool = False) -> DataFrame:
    """CSV scan with header. A declared schema (default) skips the inference
    pass over the whole file; ``infer=True`` reproduces type inference."""
    r = spark.read.option("header", "true")
    if infer or schema is None:
        r = r.option("inferSchema", "true")
    else:
        r = r.schema(schema)
    return r.csv(path)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name and size in MB of each landed file. Only the file metadata is
    read: the ``content`` column is pruned from the binary-file scan."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", "true").load(path))
    return df.select(
        F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024.0 * 1024.0), 1).alias("size_mb"),
    )


def read_path(spark: SparkSession, uri: str, fmt: str = "parquet") -> DataFrame:
    """Scan a table by storage URI."""
    return spark.read.format(fmt).load(uri)


def write_artifact_csv(df: DataFrame, path: str) -> str:
    """Small result frames (confusion matrix, importances) as one CSV file.

    Only for frames with a fixed small size; ``coalesce(1)`` puts them in
    one task."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def cast_schema(df: DataFrame, types: dict[str, T.DataType] = S.SILVER_TYPES,
                strict: bool = False) -> DataFrame:
    """Cast columns in one projection with ``try_cast``.

    A value that does not convert becomes null; ``cast_rejects`` counts
    them. ``strict=True`` uses the ANSI cast, which raises instead.
    """
    out = []
    for c in df.columns:
        if c in types:
            src = F.col(c)
            out.append((src.cast(types[c]) if strict else src.try_cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def cast_rejects(df: DataFrame, types: dict[str, T.DataType] = S.SILVER_TYPES) -> DataFrame:
    """One row: per cast column, rows whose non-null value failed to convert."""
    cols = [c for c in df.columns if c in types]
    return df.agg(*[
        F.sum(flag(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull())).cast("long").alias(c)
        for c in cols
    ])
