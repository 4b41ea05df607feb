"""Intermediate tables in the shared folder: they cut lineage, so a lost executor costs no recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.session import BATCH, bound_batches, fresh_dir

__all__ = ["BATCH", "bound_batches", "staged"]


def staged(df: DataFrame, label: str, *partition_by: str, rows: int = 0) -> DataFrame:
    """Writes ``df`` once below ``spark.checkpoint.dir``, at most ``rows`` rows to a file (0: any number), and reads it back."""
    path = fresh_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
