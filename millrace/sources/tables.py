"""Opening the tables of a data folder, and writing tables so that readers never see half of one."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ship_package

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Attribute access to ``<folder>/<name>.parquet``; each table is resolved once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        ship_package(spark)
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]


def content_stamp(df: DataFrame) -> str:
    """Digest of the names, sizes and times of the files that ``df`` reads; lists files and runs no job."""
    spark, seen = df.sparkSession, hashlib.sha256()
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        seen.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    return seen.hexdigest()


class VersionedTable:
    """A parquet table whose content changes by writing a new folder and switching a pointer.

    A job that reads the table and computes its successor never overwrites what it is reading,
    and a failed write leaves the old version in place.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @cached_property
    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _pointer(self) -> tuple[int, str | None, int | None]:
        """Number, folder and note of the current version."""
        pointer = f"{self.root}/_current"
        if not self._exists(pointer):
            return 0, None, None
        newest = (self.spark.read.schema("seq long, folder string, upto long").json(pointer)
                  .agg(F.max(F.struct("seq", "folder", "upto"))).first()[0])
        return tuple(newest) if newest else (0, None, None)

    def version(self) -> str | None:
        """Folder name of the current version."""
        return self._pointer()[1]

    def current(self) -> tuple[DataFrame | None, int | None]:
        """The current version, if there is one, and the ``upto`` it was written with."""
        _, folder, upto = self._pointer()
        return (None if folder is None else self.spark.read.parquet(f"{self.root}/{folder}")), upto

    def read(self) -> DataFrame:
        found, _ = self.current()
        if found is None:
            raise FileNotFoundError(f"no version of {self.root} has been written")
        return found

    def replace(self, df: DataFrame, cluster_by: Sequence[str] = (), rows_per_file: int = 0, upto: int | None = None) -> str:
        """Write ``df`` as the new version (an idempotent truncate-and-reload).

        ``cluster_by`` range-partitions and sorts by columns that readers filter on, so that
        file statistics let them skip files; ``rows_per_file`` bounds the size of a file. ``upto`` is a
        number kept with the version: readers get both or neither.
        """
        folder = f"v-{uuid.uuid4().hex}"
        out = df
        if cluster_by:
            out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        writer = out.write.mode("errorifexists")
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.parquet(f"{self.root}/{folder}")
        (self.spark.createDataFrame([(self._pointer()[0] + 1, folder, upto)], "seq long, folder string, upto long").coalesce(1)
         .write.mode("append").json(f"{self.root}/_current"))
        return folder

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions; running readers may still use the last but one."""
        pointer = f"{self.root}/_current"
        if not self._exists(pointer):
            return []
        kept = {r.folder for r in self.spark.read.schema("seq long, folder string").json(pointer).orderBy(F.desc("seq")).limit(keep).collect()}
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.root))]
        old = sorted(n for n in found if n.startswith("v-") and n not in kept)
        for name in old:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
        return old
