"""Messages and the calls that follow them, joined while both arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.timing import gap_seconds
from millrace.streaming.sync import _log, _once, finished_batch


def start_trace(messages: DataFrame, calls: DataFrame, session: str, message_ts: str, call_ts: str, root: str,
                within: str = "10 minutes", lateness: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """Left-join a stream of messages to the calls of the same session at most ``within`` later.

    Both times need zone semantics. A message without a call is given out once, when no call can come
    any more: both streams have passed it by ``within`` and ``lateness``. So state holds the messages and calls
    of that stretch and nothing older. Rows that come later than ``lateness`` cannot be joined any
    more; :func:`dropped_rows` counts them. Without new rows on either stream nothing is given out;
    a row with a session but without an id on both moves the time on, and is not shown. (A row
    with a NULL session does not: a call without a session is filtered before its time is seen.)
    """
    left = messages.withWatermark(message_ts, lateness)
    right = calls.withColumnRenamed(session, "_session").withWatermark(call_ts, lateness)
    joined = left.join(right, (F.col(session) == F.col("_session")) & (F.col(call_ts) >= F.col(message_ts))
                       & (F.col(call_ts) <= F.col(message_ts) + F.expr(f"INTERVAL {within}")), "left_outer").drop("_session")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    return (joined.writeStream.outputMode("append").foreachBatch(_once(root, write)).trigger(**(trigger or {"availableNow": True}))
            .option("checkpointLocation", f"{root}/_checkpoint").start())


def trace_table(spark: SparkSession, root: str, message: Sequence[str], message_ts: str, call_ts: str, call_id: str, payload: Sequence[str]) -> DataFrame:
    """Each finished message (its columns ``message``) with the first call after it, and seconds until that; none gives NULL."""
    log = _log(spark, root, None, None, finished_batch(spark, root))
    if log is None:
        raise FileNotFoundError(f"no batch of {root} is finished")
    first = F.min(F.struct(call_ts, call_id, *payload)).alias("_call")
    found = log.filter(F.col(message[0]).isNotNull()).groupBy(*message).agg(first)
    return (found.select(*message, F.col(f"_call.{call_ts}").alias(f"matched_{call_ts}"), *[F.col(f"_call.{c}").alias(c) for c in (call_id, *payload)])
            .withColumn("seconds_to_call", gap_seconds(message_ts, f"matched_{call_ts}")))


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came too late to be joined, over the batches that the query still remembers."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def held_rows(query: StreamingQuery) -> int:
    """Rows in state after the last batch."""
    return sum(int(o["numRowsTotal"]) for o in query.lastProgress["stateOperators"])
