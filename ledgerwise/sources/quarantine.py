"""Raw CSV with a lane for what does not fit: every landed line is accepted or kept with a reason.

Files are read as lines with the file they came from. A line is parsed with all columns as text first;
a wrong number of fields rejects it (``columns``), then each column is converted with ``try_cast``, and a value
that is there but does not convert rejects the line too (``cast: V1, Amount``). Header
lines (equal to the header given or made from the schema) and blank lines are no rows. A quoted
field may hold separators but no line break.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

CORRUPT = "_corrupt_record"


@dataclass
class Landed:
    accepted: DataFrame   # the typed rows
    rejected: DataFrame   # (file, reason, raw)


def _parsed(lines: DataFrame, schema: T.StructType, header: str) -> DataFrame:
    """(file, raw, reason, row): reason is null for a row that fits."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` STRING" for f in texts.fields)
    rows = lines.filter((F.trim("value") != "") & (F.trim("value") != header))
    rows = rows.withColumn("_t", F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    own = {f.name: F.col("_t").getField(f.name) for f in schema.fields}
    bad = [F.when(own[f.name].isNotNull() & own[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    failed = F.array_join(F.array_compact(F.array(*bad)), ", ")
    reason = F.when(F.col("_t").isNull() | F.col(f"_t.{CORRUPT}").isNotNull(), F.lit("columns")).when(failed != "", F.concat(F.lit("cast: "), failed))
    typed = F.struct(*[own[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return rows.select("file", F.col("value").alias("raw"), reason.alias("reason"), typed.alias("row"))


def read_landed(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA, header: str | None = None) -> Landed:
    """The typed rows of the CSV files under ``path``, and the lines that are none."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = _parsed(lines, schema, header or ",".join(schema.names))
    return Landed(parsed.filter(F.col("reason").isNull()).select("row.*"),
                  parsed.filter(F.col("reason").isNotNull()).select("file", "reason", "raw"))


def land(lake, path: str, schema: T.StructType = S.RAW_SCHEMA, accepted: str = "landed_rows", rejected: str = "quarantine",
         header: str | None = None) -> Landed:
    """``read_landed``, with both sides written as tables of ``lake``."""
    got = read_landed(lake.spark, path, schema, header)
    return Landed(lake.write(got.accepted, accepted), lake.write(got.rejected, rejected))


def quarantine_summary(rejected: DataFrame) -> DataFrame:
    """(reason, lines) of the rejected lines."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
