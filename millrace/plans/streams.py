"""The streaming jobs run over the given tables as streams, each to its end, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.plans import roles, sync  # noqa: F401
from millrace.plans.registry import REGISTRY, query
from millrace.session import fresh_dir
from millrace.sources.tables import Tables
from millrace.streaming import sync as S
from millrace.streaming import traces as T


class StreamedTables(Tables):
    """The same tables as file streams."""

    def __getattr__(self, name: str) -> DataFrame:
        still = Tables(self.spark, self.folder).__getattr__(name)
        if name not in self._open:
            # As a glob the path may be one file or a folder of files.
            path = f"{self.folder}/{{{name}.parquet}}"
            self._open[name] = self.spark.readStream.schema(still.schema).parquet(path)
        return self._open[name]


def _spec(t: Tables, label: str) -> S.SyncSpec:
    columns = StructType(list(t.orders.schema.fields))
    return S.SyncSpec(fresh_dir(t.spark, label), ("o_orderkey",), columns, policy=S.SNAPSHOT)


@query("stream_sync", REGISTRY["current_from_history"].sql)
def stream_sync(t: Tables) -> DataFrame:
    spec = _spec(t, "sync")
    S.start_sync(roles.order_history(StreamedTables(t.spark, t.folder)), spec).awaitTermination()
    return S.mirror(t.spark, spec)


@query("stream_sync_compacted", REGISTRY["current_from_history"].sql)
def stream_sync_compacted(t: Tables) -> DataFrame:
    """The same log in three batches in no order of time, with a compaction before the last one."""
    spec = _spec(t, "sync-batches")
    history = roles.order_history(t)
    inbox = fresh_dir(t.spark, "inbox")
    for part in (2, 0, 1):
        piece = history.filter(F.pmod(F.dayofyear("_commit_timestamp"), F.lit(3)) == part)
        piece.write.mode("append").parquet(inbox)
        S.start_sync(t.spark.readStream.schema(history.schema).parquet(inbox), spec).awaitTermination()
        if part == 0:
            S.compact(t.spark, spec)
            S.vacuum(t.spark, spec.root)
    return S.mirror(t.spark, spec)


@query("stream_history", f"WITH {roles.HISTORY_SQL} SELECT * FROM history")
def stream_history(t: Tables) -> DataFrame:
    spec = _spec(t, "history")
    changes = roles.order_history(StreamedTables(t.spark, t.folder))
    # The stream delivers every change twice, as after a source-side retry.
    S.start_history(changes.unionByName(changes), spec).awaitTermination()
    return S.history(t.spark, spec)


@query("stream_rollup", """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type,
  count(*) AS n, round(sum(value), 2) AS total, max(value) AS peak FROM events GROUP BY 1, 2""")
def stream_rollup(t: Tables) -> DataFrame:
    root = fresh_dir(t.spark, "rollup")
    events = StreamedTables(t.spark, t.folder).events.withColumn("ts", F.col("ts").cast("timestamp"))
    S.start_rollup(events, "ts", "1 hour", ["event_type"], "value", root).awaitTermination()
    return _shown_rollup(S.rollup_table(t.spark, root, ["event_type"]))


def _shown_rollup(table: DataFrame) -> DataFrame:
    return table.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "total": F.round("total", 2)})


def _in_turns(t: Tables, inbox: str):
    """The events in three batches: weeks late ones come last, after a compaction could have folded their windows."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    turn = F.when(F.dayofyear("ts") % 5 == 0, 2).when(F.hour("ts") % 2 == 0, 0).otherwise(1)
    for i in range(3):
        events.filter(turn == i).write.mode("append").parquet(inbox)
        yield i, t.spark.readStream.schema(events.schema).parquet(inbox)


@query("stream_rollup_late", REGISTRY["stream_rollup"].sql)
def stream_rollup_late(t: Tables) -> DataFrame:
    """Three batches, the last one weeks late, with a compaction and a vacuum before it."""
    root = fresh_dir(t.spark, "rollup-late")
    for i, events in _in_turns(t, fresh_dir(t.spark, "inbox")):
        S.start_rollup(events, "ts", "1 hour", ["event_type"], "value", root).awaitTermination()
        if i == 1:
            S.compact_rollup(t.spark, root, ["event_type"])
            S.vacuum(t.spark, root)
    return _shown_rollup(S.rollup_table(t.spark, root, ["event_type"]))


@query("stream_late_counts", """WITH e AS (SELECT *, CASE WHEN dayofyear(ts) % 5 = 0 THEN 2 WHEN hour(ts) % 2 = 0 THEN 0 ELSE 1 END AS turn FROM events),
marks AS (SELECT a.turn, max(b.ts) AS newest FROM (SELECT DISTINCT turn FROM e) a JOIN e b ON b.turn < a.turn GROUP BY 1)
SELECT turn AS batch, event_type, count(*) AS n_late FROM e JOIN marks USING (turn)
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= newest - INTERVAL 1 DAY GROUP BY 1, 2""")
def stream_late_counts(t: Tables) -> DataFrame:
    """How many events each batch of the same stream brought to windows thought complete."""
    root = fresh_dir(t.spark, "rollup-late")
    for _, events in _in_turns(t, fresh_dir(t.spark, "inbox")):
        S.start_rollup(events, "ts", "1 hour", ["event_type"], "value", root).awaitTermination()
    return S.late_rows(t.spark, root).groupBy(F.col("batch").cast("long").alias("batch"), "event_type").agg(F.sum("n").alias("n_late"))


@query("stream_sessions", """WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL
    OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 21600000000 THEN 1 ELSE 0 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM s),
g AS (SELECT user_id, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS n_events
  FROM n GROUP BY user_id, session_no)
SELECT * FROM g""")
def stream_sessions(t: Tables) -> DataFrame:
    """All sessions of the stream, closed or still open."""
    root = fresh_dir(t.spark, "sessions")
    events = StreamedTables(t.spark, t.folder).events.withColumn("ts", F.col("ts").cast("timestamp"))
    S.start_sessions(events, "user_id", "ts", "6 hours", root).awaitTermination()
    return _shown_sessions(S.sessions_table(t.spark, root, "user_id", "6 hours"))


def _shown_sessions(table: DataFrame) -> DataFrame:
    return table.drop("closed").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")})


@query("stream_sessions_late", REGISTRY["stream_sessions"].sql)
def stream_sessions_late(t: Tables) -> DataFrame:
    """Three batches, the last one weeks late: it extends and joins sessions that were closed and folded."""
    root = fresh_dir(t.spark, "sessions-late")
    for i, events in _in_turns(t, fresh_dir(t.spark, "inbox")):
        S.start_sessions(events, "user_id", "ts", "6 hours", root).awaitTermination()
        if i == 1:
            S.compact_sessions(t.spark, root, "user_id", "6 hours")
            S.vacuum(t.spark, root)
    return _shown_sessions(S.sessions_table(t.spark, root, "user_id", "6 hours"))


@query("stream_trace", f"""WITH {roles.CALLS_SQL},
m AS (SELECT event_id AS message_id, session_id, ts AS said_at FROM calls WHERE tool_name = 'view'),
p AS (SELECT event_id AS call_id, session_id, ts AS called_at, duration_ms FROM calls WHERE tool_name = 'purchase'),
j AS (SELECT message_id, m.session_id, said_at, call_id, called_at, duration_ms
  FROM m ASOF LEFT JOIN p ON m.session_id = p.session_id AND m.said_at <= p.called_at),
k AS (SELECT *, called_at <= said_at + INTERVAL 6 HOUR AS near FROM j)
SELECT message_id, session_id, said_at, CASE WHEN near THEN call_id END AS call_id, CASE WHEN near THEN called_at END AS matched_called_at,
  CASE WHEN near THEN duration_ms END AS duration_ms, CASE WHEN near THEN (epoch_us(called_at) - epoch_us(said_at)) / 1e6 END AS seconds_to_call
FROM k""")
def stream_trace(t: Tables) -> DataFrame:
    """Views and the purchases within six hours, as two streams in three stretches of time and a closing row."""
    root, inbox = fresh_dir(t.spark, "trace"), fresh_dir(t.spark, "inbox")
    log = roles.calls(t).drop("args").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = log.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    stretch = F.least(F.floor((F.unix_seconds("ts") - F.lit(low)) * 3 / F.lit(high - low + 1)), F.lit(2))
    named = {"session_id": F.lit(0), "ts": F.timestamp_seconds(F.lit(high + 8 * 86_400)), "tool_name": F.explode(F.array(F.lit("view"), F.lit("purchase")))}
    tail = t.spark.range(1).select(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) if f.name != "tool_name" else named["tool_name"].alias("tool_name")
                                     for f in log.schema.fields])
    for part in (*[log.filter(stretch == i) for i in range(3)], tail):
        part.write.mode("append").parquet(inbox)
        calls = t.spark.readStream.schema(log.schema).parquet(inbox)
        messages = calls.filter("tool_name = 'view'").select(F.col("event_id").alias("message_id"), "session_id", F.col("ts").alias("said_at"))
        made = calls.filter("tool_name = 'purchase'").select(F.col("event_id").alias("call_id"), "session_id", F.col("ts").alias("called_at"), "duration_ms")
        T.start_trace(messages, made, "session_id", "said_at", "called_at", root, "6 hours", "1 hour").awaitTermination()
    found = T.trace_table(t.spark, root, ["message_id", "session_id", "said_at"], "said_at", "called_at", "call_id", ["duration_ms"])
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("said_at", "matched_called_at")})
