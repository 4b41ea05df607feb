"""Reading an operational database through Spark's JDBC source, and upserting into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 split_on: str | None = None, bounds: tuple[Any, Any] | None = None,
                 splits: int = 1, fetch_rows: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options. With ``split_on`` the table is read by ``splits`` parallel range queries;
    filters, columns, aggregates and limits are pushed to the database either way."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_rows), "pushDownPredicate": "true",
               "pushDownAggregate": "true", "pushDownLimit": "true"}
    options["dbtable" if table else "query"] = table or query or ""
    if split_on:
        if query:
            raise ValueError("a parallel read needs a table, not a query")
        if not bounds or splits < 2:
            raise ValueError("a parallel read needs bounds and at least two splits")
        options |= {"partitionColumn": split_on, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(splits)}
    return options | dict(extra or {})


def read_jdbc(spark: SparkSession, **arguments: Any) -> DataFrame:
    """Federated scan; arguments as for :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**arguments)).load()


def staged_upsert_sql(target: str, staging: str, keys: Sequence[str], columns: Sequence[str],
                      seq: str | None = None) -> str:
    """Statement that moves staged rows into a keyed table; ``seq`` keeps newer rows."""
    values = [c for c in columns if c not in keys]
    listed = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in values)
    guard = f" WHERE {target}.{seq} <= EXCLUDED.{seq}" if seq else ""
    action = f"DO UPDATE SET {updates}{guard}" if values else "DO NOTHING"
    return (f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) {action}")


def write_staging(df: DataFrame, url: str, staging: str, writers: int = 8, batch_rows: int = 1000,
                  extra: Mapping[str, str] | None = None) -> None:
    """Load a staging table, emptied first, from a bounded number of connections."""
    (df.repartition(writers, F.xxhash64(*df.columns)).write.format("jdbc").mode("overwrite")
     .options(url=url, dbtable=staging, truncate="true", batchsize=str(batch_rows), **dict(extra or {}))
     .save())
