import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.timing import stamp
from millrace.operators import cdc
from tests.conftest import rows

SCHEMA = "id long, name string, score double"
CHANGES = SCHEMA + ", _change_type string, _commit_timestamp timestamp_ntz"


def at(minute):
    return dt.datetime(2024, 3, 1, 9, 0) + dt.timedelta(minutes=minute)


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "ada", 0.1), (2, "bo", None), (3, None, 0.3)], SCHEMA)


def test_upsert_replaces_and_inserts(spark, people):
    source = spark.createDataFrame([(2, "bob", 0.9), (4, "dee", 0.4)], SCHEMA)
    assert rows(cdc.merge_upsert(people, source, ["id"])) == [
        (1, "ada", 0.1), (2, "bob", 0.9), (3, None, 0.3), (4, "dee", 0.4)]


def test_insert_only_keeps_existing(spark, people):
    source = spark.createDataFrame([(2, "bob", 0.9), (4, "dee", 0.4)], SCHEMA)
    assert rows(cdc.merge_insert_only(people, source, ["id"]))[1] == (2, "bo", None)


def test_insert_ignore_takes_first_per_key_and_needs_keys(spark, people):
    source = spark.createDataFrame([(7, "b", 2.0), (7, "a", 1.0), (1, "z", 9.0)], SCHEMA)
    out = rows(cdc.insert_ignore(people, source, ["id"], ["score"]))
    assert (7, "a", 1.0) in out and len(out) == 4
    with pytest.raises(ValueError):
        cdc.insert_ignore(people, source, [], ["score"])


@pytest.mark.parametrize("limit", [0, 1 << 63])
def test_several_changes_per_key_use_the_last(spark, people, limit):
    changes = spark.createDataFrame([
        (1, "x", 1.0, "update", at(1)), (1, "y", 2.0, "delete", at(2)),
        (9, "n", 5.0, "insert", at(1)), (9, "n2", 6.0, "update", at(3)),
        (8, "gone", 1.0, "insert", at(1)), (8, "gone", 1.0, "delete", at(2))], CHANGES)
    assert rows(cdc.apply_changes(people, changes, ["id"], limit=limit)) == [
        (2, "bo", None), (3, None, 0.3), (9, "n2", 6.0)]


@pytest.mark.parametrize("limit", [0, 1 << 63])
def test_older_change_is_ignored(spark, limit):
    target = spark.createDataFrame([(1, "new", at(10)), (2, "old", at(0)), (3, "same", at(5)), (4, "keep", at(1))], "id long, name string, seen timestamp_ntz")
    changes = spark.createDataFrame(
        [(1, "late", at(5), "update", at(5)), (2, "fresh", at(5), "update", at(5)), (3, "tie", at(5), "update", at(5)),
         (4, "none", None, "delete", None), (6, "add", None, "insert", None)],
        "id long, name string, seen timestamp_ntz, _change_type string, _commit_timestamp timestamp_ntz")
    out = cdc.apply_changes_ordered(target, changes, ["id"], "seen", limit=limit)
    assert rows(out) == [(1, "new", at(10)), (2, "fresh", at(5)), (3, "tie", at(5)), (4, "keep", at(1)),
                         (6, "add", None)]


TABLE = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["a", "b", None]),
                                                     st.sampled_from([0.5, 1.5, None])), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=TABLE, new=TABLE)
def test_feed_applied_to_old_gives_new(spark, old, new):
    a, b = (spark.createDataFrame([(k, *v) for k, v in t.items()], SCHEMA) for t in (old, new))
    feed = cdc.change_feed(a, b, ["id"], stamp("2024-03-01 00:00:00"))
    assert rows(cdc.apply_changes(a, feed, ["id"])) == rows(b)
    assert cdc.change_feed(b, b, ["id"], stamp("2024-03-01 00:00:00")).count() == 0


def test_null_edit_is_an_update(spark, people):
    edited = people.withColumn("name", F.when(F.col("id") == 3, "cy").otherwise(F.col("name")))
    feed = cdc.change_feed(people, edited, ["id"], stamp("2024-03-01 00:00:00"))
    assert [(r.id, r._change_type) for r in feed.collect()] == [(3, "update")]


def test_history_reads(spark):
    history = spark.createDataFrame([
        (1, "a", 1.0, "insert", at(0)), (1, "b", 2.0, "update", at(5)), (1, "b", 2.0, "delete", at(9)),
        (2, "c", 3.0, "insert", at(3))], CHANGES)
    columns = ["id", "name", "score"]
    assert rows(cdc.current_from_history(history, ["id"], columns)) == [(2, "c", 3.0)]
    assert rows(cdc.as_of(history, ["id"], columns, F.lit(at(5)))) == [(1, "b", 2.0), (2, "c", 3.0)]
    assert rows(cdc.as_of(history, ["id"], columns, F.lit(at(60)))) == [(2, "c", 3.0)]
    again = cdc.append_history(history, history, ["id"])
    assert again.count() == history.count()


def test_restore_replaces_damaged_and_returns_lost(spark, people):
    current = spark.createDataFrame([(1, "oops", 0.1), (2, "bo", None), (5, "later", 1.0)], SCHEMA)
    out = cdc.restore_rows(current, people, ["id"], F.col("name") == "oops")
    assert rows(out) == [(1, "ada", 0.1), (2, "bo", None), (3, None, 0.3), (5, "later", 1.0)]


def test_branch_leaves_base_untouched_and_reports_conflicts(spark, people):
    before = rows(people)
    mine = spark.createDataFrame([(1, "mine", 1.0, "update", at(1)), (2, "bo", None, "delete", at(1))], CHANGES)
    theirs = spark.createDataFrame([(1, "theirs", 1.0, "update", at(2)), (3, "t", 1.0, "update", at(2))], CHANGES)
    assert rows(cdc.overlay(people, mine, ["id"])) == [(1, "mine", 1.0), (3, None, 0.3)]
    assert rows(people) == before
    promoted, conflicts = cdc.promote(people, theirs, mine, ["id"])
    assert rows(conflicts) == [(1,)]
    assert rows(promoted) == [(1, "mine", 1.0), (3, "t", 1.0)]


def test_delete_keeps_rows_with_unknown_condition(spark, people):
    assert [r[0] for r in rows(cdc.delete_where(people, F.col("score") < 0.2))] == [2, 3]


def test_fk_lookup_unknown_is_null_and_duplicates_raise(spark):
    incoming = spark.createDataFrame([("x@a", 1), ("y@a", 2)], "email string, qty int")
    users = spark.createDataFrame([("x@a", 10)], "email string, user_id long")
    assert rows(cdc.insert_fk_lookup(incoming, users, "email", "user_id", "fk")) == [(1, 10), (2, None)]
    twice = users.unionByName(spark.createDataFrame([("x@a", 11)], users.schema))
    with pytest.raises(Exception, match="more than one row"):
        cdc.insert_fk_lookup(incoming, twice, "email", "user_id", "fk").collect()


def test_generated_ids_continue_and_are_dense(spark):
    target = spark.createDataFrame([(41, "a")], "id long, word string")
    batch = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("n"), F.lit("w").alias("word"))
    table, new = cdc.append_generated_ids(target, batch, "id", ["n"])
    assert sorted(r.id for r in new.collect()) == list(range(42, 1042))
    assert table.count() == 1001


def test_mirror_drift_and_difference(spark, people):
    assert cdc.mirror_drift(people, people, ["id"]).count() == 0
    assert cdc.snapshot_difference(people, people).count() == 0
    other = people.filter("id <> 1").unionByName(spark.createDataFrame([(4, "d", 1.0)], SCHEMA))
    assert rows(cdc.mirror_drift(people, other, ["id"])) == [(1, "missing"), (4, "unexpected")]
    assert rows(cdc.snapshot_difference(people, other).select("id", "extra_in_a")) == [(1, 1), (4, -1)]


def test_promotion_moves_each_approved_row_once(spark):
    staging = spark.createDataFrame([(1, True, False), (2, True, True), (3, False, False), (4, True, None)],
                                    "id long, approved boolean, busy boolean")
    moved = cdc.promote_approved(staging, spark.createDataFrame([(4,)], "id long"), ["id"],
                                 F.col("approved"), F.col("busy"))
    assert [r.id for r in moved.collect()] == [1]


def test_freshness_counts_pending(spark):
    source = spark.createDataFrame([(1, 1, at(0)), (2, 1, at(0))], "id long, v int, committed timestamp_ntz")
    target = spark.createDataFrame([(1, 1, at(2))], "id long, v int, applied timestamp_ntz")
    assert rows(cdc.freshness_lag(source, target, ["id"], "v", "committed", "applied")) == [(1, 1, 120.0, 120.0)]


KEYS = st.integers(1, 4) | st.none()
TARGET = st.lists(st.tuples(KEYS, st.sampled_from(["a", "b", None]), st.integers(0, 9) | st.none()), max_size=7)
LOG = st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["x", "y"]), st.integers(0, 9), st.sampled_from(["update", "delete", "insert"])),
               max_size=6, unique_by=lambda c: (c[0], c[2]))


def fold_by_hand(target, log, ordered):
    last = {}
    for k, v, m, kind in log:
        if k not in last or m > last[k][1]:
            last[k] = (v, m, kind)
    if ordered:
        for k, _, m in target:
            if k in last and m is not None and last[k][1] < m:
                del last[k]
    kept = [t for t in target if t[0] not in last or t[0] is None]
    return kept + [(k, v, m) for k, (v, m, kind) in last.items() if kind != "delete"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=TARGET, log=LOG)
def test_one_meaning_whatever_the_size(spark, target, log):
    """Rows without a key, repeated keys and untouched rows stay, however the keys are matched."""
    table = spark.createDataFrame([(k, v, None if m is None else at(m)) for k, v, m in target], "id long, name string, seen timestamp_ntz")
    changes = spark.createDataFrame([(k, v, at(m), kind, at(m)) for k, v, m, kind in log],
                                    "id long, name string, seen timestamp_ntz, _change_type string, _commit_timestamp timestamp_ntz")
    for limit in (0, 1 << 63):
        for ordered, out in ((False, cdc.apply_changes(table, changes, ["id"], limit=limit)),
                             (True, cdc.apply_changes_ordered(table, changes, ["id"], "seen", limit=limit))):
            expected = [(k, v, None if m is None else at(m)) for k, v, m in fold_by_hand(target, log, ordered)]
            assert rows(out) == sorted(expected, key=str)


def test_deletion_outlives_older_changes(spark):
    schema = "id long, name string, seen timestamp_ntz"
    table = spark.createDataFrame([(1, "a", at(0))], schema)
    change = lambda *c: spark.createDataFrame(list(c), schema + ", _change_type string, _commit_timestamp timestamp_ntz")
    first = change((1, "a", at(9), "delete", at(9)))
    after = cdc.apply_changes_ordered(table, first, ["id"], "seen")
    gone = cdc.next_tombstones(None, first, ["id"])
    assert rows(cdc.apply_changes_ordered(after, change((1, "old", at(5), "update", at(5))), ["id"], "seen", tombstones=gone, limit=0)) == []
    late = change((1, "old", at(5), "update", at(5)))
    assert rows(cdc.apply_changes_ordered(after, late, ["id"], "seen", tombstones=gone)) == []
    gone = cdc.next_tombstones(gone, late, ["id"])
    assert rows(gone) == [(1, at(9))]
    new = change((1, "new", at(12), "insert", at(12)))
    assert rows(cdc.apply_changes_ordered(after, new, ["id"], "seen", tombstones=gone)) == [(1, "new", at(12))]
    assert rows(cdc.next_tombstones(gone, new, ["id"])) == []


def test_bad_keys_are_refused(spark, people):
    twice = spark.createDataFrame([(2, "x", 0.1), (2, "y", 0.2)], SCHEMA)
    nobody = spark.createDataFrame([(None, "x", 0.1), (None, "y", 0.2)], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        cdc.merge_upsert(people, twice, ["id"]).collect()
    assert cdc.merge_upsert(people, nobody, ["id"]).count() == 5
    columns = ["id", "name", "score"]
    assert rows(cdc.sync_snapshot(people, ["id"], columns)) == rows(people)
    for bad, message in ((twice, "more than one row"), (nobody, "without a key")):
        with pytest.raises(Exception, match=message):
            cdc.sync_snapshot(people.unionByName(bad), ["id"], columns).collect()
    refused = cdc.sync_rejects(people.unionByName(twice).unionByName(nobody), ["id"], ["id", "name"])
    assert rows(refused) == sorted([(2, "bo", "repeated key"), (2, "x", "repeated key"), (2, "y", "repeated key"),
                                    (None, "x", "missing key"), (None, "y", "missing key")], key=str)
    with pytest.raises(Exception, match="without a key"):
        cdc.apply_changes(people, spark.createDataFrame([(None, "x", 1.0, "insert", at(0))], CHANGES), ["id"]).collect()


def test_changes_of_one_commit_are_all_kept(spark):
    feed = spark.createDataFrame([(1, "a", 1.0, "insert", at(0)), (1, "b", 1.0, "update", at(0)), (1, "c", None, "update", at(0)),
                                  (2, None, None, "insert", None), (1, "a", 1.0, "insert", at(0))], CHANGES)
    once = cdc.append_history(feed.limit(0), feed, ["id"])
    assert once.count() == 4
    assert rows(cdc.append_history(once, feed, ["id"])) == rows(once)
