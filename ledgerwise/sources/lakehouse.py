"""Path-based table store for the medallion layers.

Tables live as ``<root>/<name>`` in a columnar format (parquet by default;
``delta`` when its jars are on the classpath). With ``catalog=True`` the
writes go through ``saveAsTable`` instead. Every write returns a fresh scan
of what was written, so reports read the table rather than rerunning its
plan.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, _join


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str
    fmt: str = "parquet"
    catalog: bool = False

    @classmethod
    def scratch(cls, spark: SparkSession, name: str = "lakehouse") -> "Lakehouse":
        """A store under the session's checkpoint folder (shared on a cluster)."""
        return cls(spark, _join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}"))

    def path(self, name: str) -> str:
        """Files of ``name``; with a catalog, ``root`` is a database and files that
        are no tables (models, artifacts) go beside its tables."""
        if self.catalog:
            return _join(self.spark.catalog.getDatabase(self.spark.catalog.currentDatabase()).locationUri, f"_files/{self.root}/{name}")
        return _join(self.root, name)

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        if self.catalog:
            df.write.format(self.fmt).mode(mode).saveAsTable(name)
        else:
            df.write.format(self.fmt).mode(mode).save(self.path(name))
        return self.read(name)

    def write_audited(self, df: DataFrame, name: str, audit: Callable[[DataFrame], object]) -> DataFrame:
        """Write ``df`` beside the table and let ``audit(staged rows)`` judge what was written. If it
        raises, the staged rows go and the table stays as it is; else they take its place. The old
        files are moved aside for the exchange, and removed after it."""
        staged = self.path(f"_staged/{name}-{uuid.uuid4().hex}")
        try:
            df.write.format(self.fmt).mode("error").save(staged)
            rows = self.spark.read.format(self.fmt).schema(df.schema).load(staged)
            audit(rows)
            if self.catalog:
                return self.write(rows, name)
            self._exchange(staged, self.path(name))
            return self.read(name)
        finally:
            self._delete(staged)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def _exchange(self, new: str, place: str) -> None:
        src, fs = self._fs(new)
        dst, _ = self._fs(place)
        aside, _ = self._fs(f"{place}.old-{uuid.uuid4().hex}")
        there = fs.exists(dst)
        if there and not fs.rename(dst, aside):
            raise OSError(f"could not move {place} aside")
        if not fs.rename(src, dst):
            if there:
                fs.rename(aside, dst)
            raise OSError(f"could not move {new} to {place}")
        if there:
            fs.delete(aside, True)

    def claim(self, name: str) -> bool:
        """Create the empty file ``name``; False if it is there already. Of several jobs that claim one
        name at once, one gets it: the file is created exclusively."""
        path = self.path(f"_claims/{name}")
        p, fs = self._fs(path)
        fs.mkdirs(p.getParent())
        if fs.getUri().getScheme() == "file":
            try:
                os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL))
                return True
            except FileExistsError:
                return False
        try:
            fs.create(p, False).close()
            return True
        except Exception as e:
            if fs.exists(p):
                return False
            raise e

    def write_bucketed(self, df: DataFrame, name: str, by: Sequence[str], buckets: int) -> DataFrame:
        """A catalog table dealt by a hash of ``by`` into sorted buckets: joins and groupings by
        these columns with a table dealt alike move no rows."""
        parts = df.repartition(buckets, *[F.col(c) for c in by])
        w = parts.write.format(self.fmt).mode("overwrite").bucketBy(buckets, by[0], *by[1:]).sortBy(by[0], *by[1:])
        w.saveAsTable(name)
        return self.spark.table(name)

    def read(self, name: str) -> DataFrame:
        if self.catalog:
            return self.spark.table(name)
        return self.spark.read.format(self.fmt).load(self.path(name))

    def exists(self, name: str) -> bool:
        if self.catalog:
            return self.spark.catalog.tableExists(name)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def view(self, name: str) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(name)
        return df
