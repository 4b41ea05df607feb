"""Joins of a large table to a keyed lookup when a few keys hold most of the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_dir

#: Largest planned size of a side that is broadcast. Planned sizes are those of compressed
#: files, so this leaves room for a tenfold larger table in memory.
BROADCAST_LIMIT = 32 * 1024 * 1024
UNBOUNDED = 1 << 62
_MULTIPLIES = re.compile(r"\b(Generate|MapInArrow|MapInPandas|FlatMapCoGroupsInArrow|LogicalRDD)\b")
#: Fact rows of one key that a join task should have at most; busier keys are split.
TASK_ROWS = 500_000


def planned_bytes(df: DataFrame) -> int:
    """Upper estimate of a plan's size; runs no job.

    The optimizer's estimate errs on the large side for filters, joins and aggregates. It does
    not see rows multiplied by a generator or by Python code, so such plans count as unbounded.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if _MULTIPLIES.search(plan.toString()):
        return UNBOUNDED
    return int(str(plan.stats().sizeInBytes()))


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null keys, deduplicated before any shuffle on them."""
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return df.select(*keys).filter(present).distinct()


def busy_keys(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more than ``task_rows`` rows, and into how many parts (``_parts``) each is to be cut.

    Counted before the shuffle; at most ``rows / task_rows`` keys come out.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > task_rows).select(*keys, F.ceil(F.col("_n") / F.lit(task_rows)).cast("int").alias("_parts"))


def settle(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """Run ``df`` once. A result of at most ``rows`` rows comes back as a local relation, whose
    size the optimizer knows exactly; a larger one is checkpointed to the shared folder."""
    head = df.limit(rows + 1).toArrow()
    if head.num_rows <= rows:
        return df.sparkSession.createDataFrame(head, df.schema)
    shared_dir(df.sparkSession)
    return df.checkpoint()


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner",
                limit: int = BROADCAST_LIMIT, task_rows: int = TASK_ROWS) -> DataFrame:
    """Join many rows to a lookup that has at most one row per key.

    A lookup whose planned size is within ``limit`` is broadcast, so nothing moves. Otherwise
    both sides are shuffled on the key. Keys with more than ``task_rows`` fact rows are cut into as
    many parts as that takes, and their lookup rows are repeated once per part; how many is
    measured, in one count before the join. Rows with a NULL key, which match nothing, are spread
    too. The part is a hash of the row, so a retried task produces the same partitioning.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    if planned_bytes(lookup) <= limit:
        return facts.join(F.broadcast(lookup), keys, how)
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    busy = settle(busy_keys(facts.filter(present), keys, task_rows))
    if planned_bytes(busy) <= limit:
        busy = F.broadcast(busy)
    parts = F.when(~present, F.lit(1024)).otherwise(F.coalesce("_parts", F.lit(1)))
    cut = (facts.join(busy, keys, "left")
           .withColumn("_part", F.pmod(F.xxhash64(*facts.columns), parts.cast("long")).cast("int")).drop("_parts"))
    repeated = (lookup.join(busy, keys, "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts"))
    return cut.join(repeated, [*keys, "_part"], how).drop("_part")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a scan that has too few splits for expensive per-row work.

    Where the input already has about as many splits as there are cores, nothing moves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 > cores else df.repartition(cores, key)
