"""Continuous keyed sync, history append and rollups with Structured Streaming.

The sinks write one folder per micro-batch and, after it, a marker row; a batch that is restarted
before its marker overwrites its folder, and one that has it is left alone. Readers and compaction
use marked batches: those are complete and are never written again. Readers see the latest change per key; what arrives late
or out of order can therefore never replace something newer. Checkpoint and data share one root,
so batch numbers always belong to the data beside them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.window import Window
from pyspark.sql.types import (DataType, IntegerType, StringType, StructType,
                               TimestampNTZType)

from millrace.functions.skew import BROADCAST_LIMIT, key_set, planned_bytes
from millrace.operators.cdc import CHANGE_TYPE, COMMIT_TS, change_identity
from millrace.operators.checks import schema_drift
from millrace.operators.keyed import latest_per_key, sessions
from millrace.sources.tables import VersionedTable

CONTINUOUS, SNAPSHOT = "continuous", "snapshot"


class SchemaDriftError(RuntimeError):
    """The source's columns no longer match the declared ones; the sync must be re-created."""


@dataclass(frozen=True)
class SyncSpec:
    """One synced table: where it lives, its key, its declared columns and its schedule.

    ``seq`` orders the changes of a key. ``continuous`` polls at ``interval``; ``snapshot``
    handles what is there and stops.
    """

    root: str
    keys: tuple[str, ...]
    columns: StructType
    seq: str = COMMIT_TS
    policy: str = CONTINUOUS
    interval: str = "10 seconds"
    order: tuple[str, ...] = ()
    seq_type: DataType = field(default_factory=TimestampNTZType)

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a synced table needs a primary key")
        if self.policy not in (CONTINUOUS, SNAPSHOT):
            raise ValueError(f"policy must be {CONTINUOUS!r} or {SNAPSHOT!r}")

    def trigger(self) -> dict[str, str | bool]:
        return {"processingTime": self.interval} if self.policy == CONTINUOUS else {"availableNow": True}

    @property
    def changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def _check_columns(spec: SyncSpec, df: DataFrame) -> None:
    want = {f.name: f.dataType for f in spec.columns.fields}
    have = {f.name: f.dataType for f in df.schema.fields
            if f.name not in (CHANGE_TYPE, COMMIT_TS, spec.seq) or f.name in want}
    if want != have:
        changed = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
        raise SchemaDriftError(f"columns differ from the declared ones: {', '.join(changed)}")


def start_sync(changes: DataFrame, spec: SyncSpec) -> StreamingQuery:
    """Start (or resume) the keyed sync of a change stream."""
    _check_columns(spec, changes)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Only the last change per key of a batch can matter; this also bounds what is stored.
        last = latest_per_key(batch, spec.keys, [F.col(spec.seq).desc(), *spec.order])
        last.write.mode("overwrite").parquet(f"{spec.changes}/batch={batch_id}")

    return (changes.writeStream.foreachBatch(_once(spec.root, write)).trigger(**spec.trigger())
            .option("checkpointLocation", spec.checkpoint).start())


_MARKER = "batch long, n_rows long, n_late long, newest timestamp"


def _markers(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished batch."""
    path = f"{root}/finished"
    return spark.read.schema(_MARKER).parquet(path) if _has_rows(spark, path) else spark.createDataFrame([], _MARKER)


def finished_batch(spark: SparkSession, root: str) -> int | None:
    """Newest batch that has been written whole."""
    return _markers(spark, root).agg(F.max("batch")).first()[0]


def _once(root: str, write: Callable[[DataFrame, int], dict | None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes a marker row after the batch, and leaves a marked batch alone."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _has_rows(spark, f"{root}/finished") and not _markers(spark, root).filter(F.col("batch") == batch_id).isEmpty():
            return
        facts = write(batch, batch_id) or {}
        row = (batch_id, facts.get("n_rows"), facts.get("n_late"), facts.get("newest"))
        spark.createDataFrame([row], _MARKER).coalesce(1).write.mode("append").parquet(f"{root}/finished")

    return run


def _log(spark: SparkSession, root: str, schema: StructType | None, after: int | None, upto: int | None) -> DataFrame | None:
    """Finished batches after ``after``; only their folders are listed and read."""
    paths = [p for b in range(-1 if after is None else after, -1 if upto is None else upto) if _has_rows(spark, p := f"{root}/changes/batch={b + 1}")]
    if not paths:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", f"{root}/changes").parquet(*paths)


def _merged(base: DataFrame | None, log: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Latest row per key. Of the base only the keys of the log are folded; its other rows stay where they are."""
    if base is None:
        return latest_per_key(log, keys, order)
    keys = list(keys)
    touched = key_set(log, keys)
    touched = F.broadcast(touched) if planned_bytes(touched) <= BROADCAST_LIMIT else touched
    stay = base.join(touched, keys, "left_anti")
    meet = base.join(touched, keys, "left_semi")
    return stay.unionByName(latest_per_key(meet.unionByName(log.select(*base.columns)), keys, order))


def _latest(spark: SparkSession, spec: SyncSpec, upto: int | None) -> DataFrame | None:
    """Last change per key over the compacted base and the finished batches after it, up to ``upto``."""
    base, done = VersionedTable(spark, f"{spec.root}/base").current()
    log = _log(spark, spec.root, _change_schema(spec), done, upto)
    if log is None:
        return base
    return _merged(base, log, spec.keys, [F.col(spec.seq).desc(), F.col("batch").desc(), *spec.order])


def mirror(spark: SparkSession, spec: SyncSpec) -> DataFrame:
    """The synced table as readers see it: everything that finished batches have brought."""
    found = _latest(spark, spec, finished_batch(spark, spec.root))
    if found is None:
        return spark.createDataFrame([], spec.columns)
    return found.filter(F.col(CHANGE_TYPE) != "delete").select(*spec.columns.names)


def compact(spark: SparkSession, spec: SyncSpec) -> str | None:
    """Fold the finished batches so far into a new base. Deletions stay recorded, so that an older change
    arriving afterwards still finds something newer than itself."""
    upto = finished_batch(spark, spec.root)
    state = _latest(spark, spec, upto)
    if state is None:
        return None
    return VersionedTable(spark, f"{spec.root}/base").replace(state, cluster_by=spec.keys, upto=upto)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the batches that the current base has folded, and old bases; returns how many folders went.

    Call it some time after :func:`compact`, when no reader uses the state before it any more.
    """
    table = VersionedTable(spark, f"{root}/base")
    _, done = table.current()
    gone = len(table.vacuum(keep))
    for batch in range(0, -1 if done is None else done + 1):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/changes/batch={batch}")
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def start_history(changes: DataFrame, spec: SyncSpec) -> StreamingQuery:
    """Append every change to a history once, however late it comes.

    A change is its key, commit, kind and values, so different changes of one commit are all kept.
    Files are sorted by commit time and a batch is compared with the commit range it covers, so
    file statistics skip the rest of the history; no watermark can discard a late change.
    """
    _check_columns(spec, changes)
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = F.struct(*change_identity(batch, spec.keys, spec.seq))
        fresh = batch.withColumn("_same", named).dropDuplicates(["_same"])
        if _has_rows(spark, spec.changes):
            low, high = batch.agg(F.min(spec.seq), F.max(spec.seq)).first()
            if low is not None:
                known = _read_history(spark, spec).filter(
                    (F.col("batch") != batch_id) & F.col(spec.seq).between(F.lit(low), F.lit(high)))
                known = known.select(*batch.columns).select(named.alias("_known"))
                fresh = fresh.join(known, F.col("_same") == F.col("_known"), "left_anti")
        (fresh.drop("_same").sortWithinPartitions(spec.seq).write.mode("overwrite")
         .parquet(f"{spec.changes}/batch={batch_id}"))

    return (changes.writeStream.foreachBatch(_once(spec.root, write)).trigger(**spec.trigger())
            .option("checkpointLocation", spec.checkpoint).start())


def _has_rows(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _change_schema(spec: SyncSpec) -> StructType:
    # Declared, not inferred: empty batches have no file to infer from.
    extra = StructType(list(spec.columns.fields))
    for name, kind in ((CHANGE_TYPE, StringType()), (spec.seq, spec.seq_type), ("batch", IntegerType())):
        if name not in extra.names:
            extra = extra.add(name, kind)
    return extra


def _read_history(spark: SparkSession, spec: SyncSpec) -> DataFrame:
    return spark.read.schema(_change_schema(spec)).option("basePath", spec.changes).parquet(spec.changes)


def history(spark: SparkSession, spec: SyncSpec) -> DataFrame:
    """The appended history."""
    return _read_history(spark, spec).drop("batch")


def _watermark(spark: SparkSession, root: str, before: int, seconds: int):
    """Newest event time of the batches before this one, less the lateness; None if there is none."""
    return (_markers(spark, root).filter(F.col("batch") < before)
            .agg(F.max("newest") - F.make_dt_interval(secs=F.lit(seconds))).first()[0])


def _seconds(spark: SparkSession, interval: str) -> int:
    return int(spark.range(1).select(F.expr(f"unix_seconds(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL '{interval}')")).first()[0])


def _write_parts(batch_id: int, root: str, parts: DataFrame, end: str, closed_after: int, lateness: int, keep: Sequence[str]) -> dict:
    """Write a batch's partial rows, and apart from them those that reach a time which was thought complete.

    ``parts`` has n (events) and newest (event time); ``end`` is where a row's time ends.
    """
    spark = parts.sparkSession
    mark = _watermark(spark, root, batch_id, lateness)
    late = F.lit(False) if mark is None else F.coalesce(F.col(end) + F.make_dt_interval(secs=F.lit(closed_after)) <= F.lit(mark), F.lit(False))
    path = f"{root}/changes/batch={batch_id}"
    parts.withColumn("late", late).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(parts.schema.add("late", "boolean")).parquet(path)
    (stored.filter("late").select(*keep, "n").write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}"))
    found = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("late"), F.col("n"))), F.lit(0)), F.max("newest")).first()
    return dict(zip(("n_rows", "n_late", "newest"), found))


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """What came late to a rollup or to sessions, by batch: it is in the totals too, and counted here."""
    return spark.read.option("basePath", f"{root}/late").parquet(f"{root}/late")


def _folded(base: DataFrame | None, log: DataFrame, keys: Sequence[str], fold) -> DataFrame:
    """``fold`` over the log and the base rows of its keys; other base rows stay where they are. NULL is a key."""
    if base is None:
        return fold(log)
    named = F.struct(*keys)
    touched = log.select(named.alias("_touched")).distinct()
    touched = F.broadcast(touched) if planned_bytes(touched) <= BROADCAST_LIMIT else touched
    here = named == F.col("_touched")
    stay, meet = base.join(touched, here, "left_anti"), base.join(touched, here, "left_semi")
    return stay.unionByName(fold(meet.unionByName(log)).select(*base.columns))


def start_rollup(events: DataFrame, ts: str, width: str, keys: Sequence[str], value: str, root: str,
                 lateness: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """Keep tumbling-window totals of an event stream in a serving table.

    ``ts`` must be a timestamp with zone semantics. Every batch appends its own count, sum and
    maximum of each window it touches; readers add them up, so an event counts in its window however
    late it comes, and nothing is held in state. Events of a window that ended ``lateness`` before the
    newest event are also counted in :func:`late_rows`. Events without a time belong to no window.
    """
    allowed = _seconds(events.sparkSession, lateness)

    def write(batch: DataFrame, batch_id: int) -> dict:
        parts = (batch.groupBy(F.window(ts, width).alias("_w"), *keys)
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("peak"), F.max(ts).alias("newest"))
                 .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, "n", "total", "peak", "newest"))
        return _write_parts(batch_id, root, parts, "window_end", 0, allowed, ["window_start", *keys])

    return (events.writeStream.foreachBatch(_once(root, write)).trigger(**(trigger or {"availableNow": True}))
            .option("checkpointLocation", f"{root}/_checkpoint").start())


def rollup_table(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Totals per window and key, from the base and the finished batches after it."""
    found = _rollup(spark, root, keys, finished_batch(spark, root))
    if found is None:
        raise FileNotFoundError(f"no batch of {root} is finished")
    return found


def _rollup(spark: SparkSession, root: str, keys: Sequence[str], upto: int | None) -> DataFrame | None:
    base, done = VersionedTable(spark, f"{root}/base").current()
    log, by = _log(spark, root, None, done, upto), ["window_start", *keys]
    if log is None:
        return base
    return _folded(base, log.select(*by, "n", "total", "peak"), by, lambda rows: rows.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("peak").alias("peak")))


def compact_rollup(spark: SparkSession, root: str, keys: Sequence[str]) -> str | None:
    """Fold the finished batches of a rollup into a new base; :func:`vacuum` then removes them."""
    upto = finished_batch(spark, root)
    state = _rollup(spark, root, keys, upto)
    return None if state is None else VersionedTable(spark, f"{root}/base").replace(state, cluster_by=["window_start"], upto=upto)


def start_sessions(events: DataFrame, key: str, ts: str, idle: str, root: str,
                   lateness: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """Keep the sessions of an event stream: runs of a key's events less than ``idle`` apart.

    Every batch appends the sessions of its own events; readers join those that touch, so an event
    that comes late extends, or joins, the sessions it belongs to. Events of sessions that had
    been idle ``lateness`` before the newest event are also counted in :func:`late_rows`.
    """
    spark = events.sparkSession
    gap, allowed = _seconds(spark, idle), _seconds(spark, lateness)

    def write(batch: DataFrame, batch_id: int) -> dict:
        parts = sessions(batch.filter(F.col(ts).isNotNull()), key, ts, gap).select(
            key, "started_at", "ended_at", F.col("n_events").alias("n"), F.col("ended_at").alias("newest"))
        return _write_parts(batch_id, root, parts, "ended_at", gap, allowed, [key, "started_at", "ended_at"])

    return (events.writeStream.foreachBatch(_once(root, write)).trigger(**(trigger or {"availableNow": True}))
            .option("checkpointLocation", f"{root}/_checkpoint").start())


def joined_sessions(parts: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """Joins a key's part sessions (started_at, ended_at, n_events) that are less than the gap apart.

    The ordered step sees a row per part, not per event.
    """
    order = Window.partitionBy(key).orderBy("started_at", "ended_at")
    before = F.max("ended_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.unix_micros("started_at") - F.unix_micros(before) >= F.lit(gap_seconds * 1_000_000), F.lit(True))
    numbered = parts.withColumn("_fresh", fresh.cast("int")).withColumn(
        "_no", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (numbered.groupBy(key, "_no").agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("n_events").alias("n_events"))
            .drop("_no"))


def _sessions(spark: SparkSession, root: str, key: str, gap: int, upto: int | None) -> DataFrame | None:
    base, done = VersionedTable(spark, f"{root}/base").current()
    log = _log(spark, root, None, done, upto)
    if log is None:
        return base
    parts = log.select(key, "started_at", "ended_at", F.col("n").alias("n_events"))
    return _folded(base, parts, [key], lambda rows: joined_sessions(rows, key, gap))


def sessions_table(spark: SparkSession, root: str, key: str, idle: str, lateness: str = "1 hour") -> DataFrame:
    """key, started_at, ended_at, n_events of all sessions so far, and whether each is ``closed``:
    idle since ``lateness`` before the newest event."""
    gap = _seconds(spark, idle)
    found = _sessions(spark, root, key, gap, finished_batch(spark, root))
    if found is None:
        raise FileNotFoundError(f"no batch of {root} is finished")
    mark = _markers(spark, root).agg(F.max("newest") - F.make_dt_interval(secs=F.lit(_seconds(spark, lateness)))).first()[0]
    return found.withColumn("closed", F.lit(False) if mark is None else F.col("ended_at") + F.make_dt_interval(secs=F.lit(gap)) <= F.lit(mark))


def compact_sessions(spark: SparkSession, root: str, key: str, idle: str) -> str | None:
    """Fold the finished batches of a session stream into a new base; :func:`vacuum` then removes them."""
    upto = finished_batch(spark, root)
    state = _sessions(spark, root, key, _seconds(spark, idle), upto)
    return None if state is None else VersionedTable(spark, f"{root}/base").replace(state, cluster_by=[key], upto=upto)


_STATUS = ("query string, batch_id long, at string, n_rows long, duration_ms long, newest_event string, "
           "watermark string")


def _status_row(p) -> tuple:
    event_time = p.eventTime or {}
    return (p.name or str(p.id), int(p.batchId), p.timestamp, int(p.numInputRows), int(p.batchDuration),
            event_time.get("max"), event_time.get("watermark"))


def _status_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    lag = F.unix_timestamp(F.to_timestamp("at")) - F.unix_timestamp(F.to_timestamp("newest_event"))
    return spark.createDataFrame(list(rows), _STATUS).withColumn("lag_seconds", lag)


def sync_status(query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query: input rows, duration, newest event time and lag."""
    rows = [_status_row(p) for p in query.recentProgress]
    return _status_table(SparkSession.active(), rows).withColumn("active", F.lit(query.isActive))


class StatusRecorder(StreamingQueryListener):
    """Records the micro-batches of all queries, and why queries ended.

    Register it with ``spark.streams.addListener``. :meth:`flush` moves what has been recorded into a
    table, so that nothing is forgotten and the driver holds only what came since.
    """

    def __init__(self) -> None:
        self.rows: deque[tuple] = deque()
        self.failures: deque[tuple[str, str]] = deque()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(_status_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append((str(event.id), event.exception))

    def table(self, spark: SparkSession, path: str | None = None) -> DataFrame:
        """The recorded micro-batches as rows, those flushed to ``path`` included."""
        fresh = _status_table(spark, list(self.rows))
        return fresh if path is None or not _has_rows(spark, path) else spark.read.schema(fresh.schema).parquet(path).unionByName(fresh)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the recorded rows to the table at ``path``."""
        taken = [self.rows.popleft() for _ in range(len(self.rows))]
        if taken:
            _status_table(spark, taken).coalesce(1).write.mode("append").parquet(path)
        return len(taken)


def drift_of(spec: SyncSpec, source: DataFrame) -> DataFrame:
    """The drift that stopped a sync, as rows."""
    return schema_drift(spec.columns, source.drop(CHANGE_TYPE, COMMIT_TS))

