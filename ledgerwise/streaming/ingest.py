"""Incremental bronze ingestion of landed raw files with Structured Streaming.

The same bronze step as ``plans.medallion.build_bronze`` (raw columns plus
ingest stamp, source and endpoint), run as a file-source stream: each new
CSV file landed in the folder is read once, with the declared schema (no
inference), and appended to the bronze table. The checkpoint (beside the
bronze table unless given) records which files were taken, so a restarted,
failed or repeated job neither drops nor repeats a file.
``trigger(availableNow=True)`` drains what has landed and stops, which keeps
it a batch job for a scheduler.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..plans.medallion import add_provenance


def landed_stream(spark: SparkSession, landing_dir: str, schema: T.StructType = S.RAW_SCHEMA,
                  pattern: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(schema).option("header", "true")
         .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing_dir)


def ingest_landed(spark: SparkSession, landing_dir: str, bronze_path: str,
                  source: str, endpoint: str, checkpoint: str | None = None, fmt: str = "parquet",
                  wait: bool = True) -> StreamingQuery:
    """Append every not-yet-ingested landed file to the bronze table."""
    stream = add_provenance(landed_stream(spark, landing_dir), source, endpoint)
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("path", bronze_path)
         .option("checkpointLocation", checkpoint or bronze_path.rstrip("/") + "_checkpoint")
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q
