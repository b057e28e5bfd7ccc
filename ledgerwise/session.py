"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "ledgerwise", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with AQE and skew handling on.

    On a cluster the master and most settings come from spark-submit; the
    values below only fill what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the master is local, as in
    tests, a fresh local folder is created and registered; on a cluster a
    machine-local folder would lose rows, so that case raises.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ledgerwise-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def _join(base: str, name: str) -> str:
    """A child path; a scheme on ``base`` (``file:/...``, ``s3a://...``) is kept."""
    return base.rstrip("/") + "/" + name


# one stack a thread: jobs that run side by side remove only their own tables
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("stage_scopes", default=())


@contextlib.contextmanager
def stage_scope(spark: SparkSession):
    """Removes the intermediate tables made inside when the block ends. For jobs
    that write their results: what is still to be read must not depend on them."""
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A unique path under the checkpoint folder for an intermediate table."""
    path = _join(checkpoint_dir(spark), f"ledgerwise-stage/{name}-{uuid.uuid4().hex}")
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from this table, not from the
    source) and, unlike ``checkpoint()``, keeps column pruning and filter
    pushdown for every later scan of the stage.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
