import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cdc
from millrace.operators import keyed as K
from millrace.operators import relational as rel
from millrace.streaming import sync as S
from tests.conftest import rows

COLUMNS = T.StructType().add("id", T.LongType()).add("v", T.StringType())
SCHEMA = "id long, v string, _change_type string, _commit_timestamp timestamp_ntz"


def at(m):
    return dt.datetime(2024, 3, 1) + dt.timedelta(minutes=m)


FIRST = [(1, "a", "insert", at(0)), (2, "b", "insert", at(1)), (3, "c", "insert", at(2))]
SECOND = [(1, "a9", "update", at(9)), (2, "b", "delete", at(8))]
LATE = [(1, "a5", "update", at(5)), (2, "b5", "update", at(5)), (4, "d", "insert", at(1)), (3, "c", "insert", at(2))]


def drop(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def spec(tmp_path, **k):
    return S.SyncSpec(str(tmp_path / "out"), ("id",), COLUMNS, policy=S.SNAPSHOT, **k)


def test_sync_over_restarts_with_late_changes(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    for i, data in enumerate((FIRST, SECOND, LATE)):
        drop(spark, inbox, data)
        S.start_sync(source(spark, inbox), s).awaitTermination()
        if i == 1:
            S.compact(spark, s)
    everything = spark.createDataFrame(FIRST + SECOND + LATE, SCHEMA)
    expected = rows(cdc.current_from_history(everything, ["id"], ["id", "v"]))
    assert expected == [(1, "a9"), (3, "c"), (4, "d")]
    assert rows(S.mirror(spark, s)) == expected
    S.compact(spark, s)
    assert rows(S.mirror(spark, s)) == expected


def test_replayed_batch_changes_nothing(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    drop(spark, inbox, FIRST)
    query = S.start_sync(source(spark, inbox), s)
    query.awaitTermination()
    before = rows(S.mirror(spark, s))
    (tmp_path / "out" / "_checkpoint" / "commits" / "0").unlink()
    (tmp_path / "out" / "_checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    assert rows(S.mirror(spark, s)) == before


def test_history_once_per_commit(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    for data in (FIRST + FIRST, SECOND + FIRST, LATE):
        drop(spark, inbox, data)
        S.start_history(source(spark, inbox), s).awaitTermination()
    assert rows(S.history(spark, s)) == sorted(set(FIRST + SECOND + LATE), key=str)


def test_drift_stops_a_sync(spark, tmp_path):
    inbox = str(tmp_path / "in")
    drop(spark, inbox, FIRST)
    s = spec(tmp_path)
    wider = source(spark, inbox).withColumn("extra", F.lit(1))
    with pytest.raises(S.SchemaDriftError, match="extra"):
        S.start_sync(wider, s)
    still = spark.createDataFrame(FIRST, SCHEMA).withColumn("extra", F.lit(1))
    assert rows(S.drift_of(s, still)) == [("extra", "added", 3)]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        S.SyncSpec("x", (), COLUMNS)
    with pytest.raises(ValueError):
        S.SyncSpec("x", ("id",), COLUMNS, policy="sometimes")
    assert S.SyncSpec("x", ("id",), COLUMNS).trigger() == {"processingTime": "10 seconds"}
    assert S.SyncSpec("x", ("id",), COLUMNS, policy=S.SNAPSHOT).trigger() == {"availableNow": True}


def test_continuous_policy_and_status(spark, tmp_path):
    inbox = str(tmp_path / "in")
    drop(spark, inbox, FIRST)
    s = S.SyncSpec(str(tmp_path / "out"), ("id",), COLUMNS, interval="0 seconds")
    recorder = S.StatusRecorder()
    spark.streams.addListener(recorder)
    query = S.start_sync(source(spark, inbox), s)
    try:
        query.processAllAvailable()
        drop(spark, inbox, SECOND)
        query.processAllAvailable()
        status = S.sync_status(query)
        assert status.agg(F.sum("n_rows")).first()[0] == 5
    finally:
        query.stop()
    for _ in range(100):
        if sum(r[3] for r in recorder.rows) == 5:
            break
        time.sleep(0.1)
    spark.streams.removeListener(recorder)
    assert recorder.table(spark).agg(F.sum("n_rows")).first()[0] == 5 and not recorder.failures
    path = str(tmp_path / "status")
    assert recorder.flush(spark, path) > 0 and not recorder.rows
    recorder.rows.append(("q", 9, "2024-01-01T00:00:00.000Z", 4, 1, None, None))
    assert recorder.table(spark, path).agg(F.sum("n_rows")).first()[0] == 9
    assert rows(S.mirror(spark, s)) == [(1, "a9"), (3, "c")]


EVENTS = "u long, ts timestamp, kind string, value double"


def test_rollup_and_sessions_equal_batch(spark, tmp_path):
    inbox = str(tmp_path / "in")
    first = [(1, at(m), "x", float(m)) for m in (0, 5, 20, 100)] + [(2, at(3), "y", 1.0)]
    second = [(1, at(10), "x", 7.0), (2, at(170), "y", 2.0), (1, at(500), "x", 1.0)]
    third = [(9, at(5000), "end", 0.0)]
    everything = spark.createDataFrame(first + second + third, EVENTS)
    for i, data in enumerate((first, second, third)):
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(inbox)
        S.start_rollup(stream(), "ts", "1 hour", ["kind"], "value", str(tmp_path / "roll")).awaitTermination()
        S.start_sessions(stream(), "u", "ts", "30 minutes", str(tmp_path / "sess"), "3 hours").awaitTermination()
    got = S.rollup_table(spark, str(tmp_path / "roll"), ["kind"])
    assert rows(got) == rows(rel.time_rollup(everything, "ts", "1 hour", ["kind"], "value"))
    found = S.sessions_table(spark, str(tmp_path / "sess"), "u", "30 minutes", "3 hours")
    columns = ["u", "started_at", "ended_at", "n_events"]
    assert rows(found.select(columns)) == rows(K.sessions(everything, "u", "ts", 1800).select(columns))
    assert rows(found.filter("not closed").select("u")) == [(9,)]


def test_late_rows_count_where_they_belong(spark, tmp_path):
    """Three batches, the last one ten days late, NULL keys among it; compacted and vacuumed in between."""
    inbox, roll, sess = (str(tmp_path / n) for n in ("in", "roll", "sess"))
    batches = [[(1, at(0), "x", 1.0), (1, at(40), "x", 2.0), (None, at(2), None, 4.0), (2, at(3), "y", 1.0)],
               [(1, at(14_400 + m), "x", 3.0) for m in (0, 10)] + [(3, at(14_400), None, 9.0)],
               [(1, at(20), "x", 5.0), (None, at(5), None, 6.0), (2, at(500), "y", 7.0), (4, None, "x", 1.0)]]
    for i, data in enumerate(batches):
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(inbox)
        S.start_rollup(stream(), "ts", "1 hour", ["kind"], "value", roll).awaitTermination()
        S.start_sessions(stream(), "u", "ts", "30 minutes", sess).awaitTermination()
        if i == 1:
            S.compact_rollup(spark, roll, ["kind"])
            S.compact_sessions(spark, sess, "u", "30 minutes")
            assert S.vacuum(spark, roll) == 2 and S.vacuum(spark, sess) == 2
    everything = spark.createDataFrame([r for b in batches for r in b if r[1]], EVENTS)
    for _ in range(2):
        assert rows(S.rollup_table(spark, roll, ["kind"])) == rows(rel.time_rollup(everything, "ts", "1 hour", ["kind"], "value"))
        columns = ["u", "started_at", "ended_at", "n_events"]
        got = S.sessions_table(spark, sess, "u", "30 minutes")
        assert rows(got.select(columns)) == rows(K.sessions(everything, "u", "ts", 1800).select(columns))
        S.compact_rollup(spark, roll, ["kind"])
        S.compact_sessions(spark, sess, "u", "30 minutes")
    assert rows(S.late_rows(spark, roll).select("batch", "window_start", "kind", "n")) == sorted(
        [(2, at(0), "x", 1), (2, at(0), None, 1), (2, at(480), "y", 1)], key=str)
    assert rows(S.late_rows(spark, sess).select("u", "n")) == sorted([(1, 1), (None, 1), (2, 1)], key=str)
    assert rows(got.filter("not closed").select("u")) == [(1,), (3,)]


def test_a_late_event_joins_two_sessions(spark, tmp_path):
    inbox, sess = str(tmp_path / "in"), str(tmp_path / "sess")
    for data in ([(1, at(0), "x", 0.0), (1, at(50), "x", 0.0)], [(1, at(25), "x", 0.0)]):
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        S.start_sessions(spark.readStream.schema(EVENTS).parquet(inbox), "u", "ts", "30 minutes", sess).awaitTermination()
    assert rows(S.sessions_table(spark, sess, "u", "30 minutes").drop("closed")) == [(1, at(0), at(50), 3)]


def test_a_marked_batch_is_not_written_again(spark, tmp_path):
    inbox, roll = str(tmp_path / "in"), str(tmp_path / "roll")
    spark.createDataFrame([(1, at(0), "x", 1.0)], EVENTS).coalesce(1).write.parquet(inbox)
    start = lambda: S.start_rollup(spark.readStream.schema(EVENTS).parquet(inbox), "ts", "1 hour", ["kind"], "value", roll).awaitTermination()
    start()
    for name in ("0", ".0.crc"):
        (tmp_path / "roll" / "_checkpoint" / "commits" / name).unlink(missing_ok=True)
    before = sorted(p.name for p in (tmp_path / "roll" / "changes" / "batch=0").iterdir())
    start()
    assert sorted(p.name for p in (tmp_path / "roll" / "changes" / "batch=0").iterdir()) == before
    assert rows(S.rollup_table(spark, roll, ["kind"]).select("n")) == [(1,)]


def test_half_a_batch_is_neither_read_nor_folded(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    assert S.mirror(spark, s).count() == 0 and S.compact(spark, s) is None
    drop(spark, inbox, FIRST)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    # The next batch is being written: one of its files is there, no marker names it.
    drop(spark, f"{s.changes}/batch=1", SECOND[:1])
    assert rows(S.mirror(spark, s)) == [(1, "a"), (2, "b"), (3, "c")]
    S.compact(spark, s)
    drop(spark, inbox, SECOND)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    assert rows(S.mirror(spark, s)) == [(1, "a9"), (3, "c")]
    S.compact(spark, s)
    assert S.vacuum(spark, s.root) == 2 and S.vacuum(spark, s.root, keep=1) == 1
    assert rows(S.mirror(spark, s)) == [(1, "a9"), (3, "c")]
    drop(spark, inbox, LATE)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    assert rows(S.mirror(spark, s)) == [(1, "a9"), (3, "c"), (4, "d")]


def test_reading_does_not_move_the_base(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    drop(spark, inbox, FIRST)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    S.compact(spark, s)
    drop(spark, inbox, SECOND)
    S.start_sync(source(spark, inbox), s).awaitTermination()
    plan = S.mirror(spark, s)._jdf.queryExecution().executedPlan().toString()
    stay = plan[:plan.index("LeftSemi")] if "LeftSemi" in plan else plan
    first = stay[stay.index("LeftAnti"):]
    assert "BroadcastHashJoin" in plan[:plan.index("LeftAnti") + 200] and "Exchange hashpartitioning" not in first[:first.index("FileScan")]


def test_different_changes_of_one_commit_stay(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), spec(tmp_path)
    data = [(1, "a", "insert", at(0)), (1, "b", "update", at(0)), (1, None, "update", at(0))]
    for _ in range(2):
        drop(spark, inbox, data + data[:1])
        S.start_history(source(spark, inbox), s).awaitTermination()
    assert rows(S.history(spark, s)) == sorted(data, key=str)


def test_rollup_is_compacted(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "roll")
    batches = [[(1, at(m), "x", float(m)) for m in (0, 5)], [(1, at(10), "x", 7.0), (2, at(170), "y", 2.0)], [(1, at(200), "x", 1.0)]]
    for i, data in enumerate(batches):
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        S.start_rollup(spark.readStream.schema(EVENTS).parquet(inbox), "ts", "1 hour", ["kind"], "value", root).awaitTermination()
        if i == 1:
            S.compact_rollup(spark, root, ["kind"])
            assert S.vacuum(spark, root) > 0
    everything = spark.createDataFrame([r for b in batches for r in b], EVENTS)
    assert rows(S.rollup_table(spark, root, ["kind"])) == rows(rel.time_rollup(everything, "ts", "1 hour", ["kind"], "value"))
