"""Memory, relational, security and check operators on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import checks as C
from millrace.operators import memory as M
from millrace.operators import relational as rel
from millrace.operators import security as S
from millrace.sources.jdbc import jdbc_options, staged_upsert_sql
from millrace.sources.tables import VersionedTable
from tests.conftest import rows


def day(n, hour=0):
    return dt.datetime(2024, 5, 1, hour) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", None), (2, 0, "user", "only")],
        "s long, turn long, role string, content string")


def test_recent_messages_come_oldest_first(messages):
    out = [tuple(r) for r in M.recent_messages(messages, "s", ["turn"], 2).select("s", "turn", "position").collect()]
    assert out == [(1, 1, 1), (1, 2, 2), (2, 0, 1)]


def test_transcript_parts_cover_everything(messages):
    whole = dict((r.s, r.transcript) for r in M.transcripts(messages, "s", "turn", "role", "content").collect())
    assert whole == {1: "user: hi\nassistant: hello\nuser: ", 2: "user: only"}
    parts = M.transcripts(messages, "s", "turn", "role", "content", part_turns=2).orderBy("s", "part").collect()
    assert [(r.s, r.part, r.n_messages) for r in parts] == [(1, 0, 2), (1, 1, 1), (2, 0, 1)]
    assert "\n".join(r.transcript for r in parts if r.s == 1) == whole[1]


def test_recall_stays_with_the_user_and_weighs_importance(spark):
    episodes = spark.createDataFrame([("a", 1, [1.0, 0.0], 0.0), ("a", 2, [0.999, 0.04], 1.0), ("b", 3, [1.0, 0.0], 1.0)],
                                     "u string, e long, v array<float>, imp double")
    asked = spark.createDataFrame([("a", 7, [1.0, 0.0])], "u string, r long, q array<float>")
    weighted = M.recall(asked, episodes, "u", 5, "r", "q", "e", "v", "imp").orderBy("rank").collect()
    plain = M.recall(asked, episodes, "u", 5, "r", "q", "e", "v", "imp", weight=0).orderBy("rank").collect()
    assert [r.e for r in weighted] == [2, 1] and [r.e for r in plain] == [1, 2]


def test_distill_is_idempotent_through_remember(spark, messages):
    talks = M.transcripts(messages, "s", "turn", "role", "content")
    made = M.distill(talks, "s", "transcript", lambda ts: [f"len {len(t)}\nIMPORTANCE: 0.9" for t in ts])
    empty = made.limit(0)
    once = M.remember(empty, made, ["s", "part"], ["summary"])
    assert rows(M.remember(once, made, ["s", "part"], ["summary"])) == rows(once)
    assert {r.importance for r in once.collect()} == {0.9}
    with pytest.raises(Exception, match="answers for"):
        M.distill(talks, "s", "transcript", lambda ts: []).collect()


def test_retention_tiers(spark):
    now = "2024-12-01 00:00:00"
    data = [(1, 0.7, day(-900)), (2, 0.69, day(-900)), (3, 0.3, dt.datetime(2024, 7, 1)), (4, 0.29, dt.datetime(2024, 7, 1)),
            (5, 0.1, dt.datetime(2024, 11, 20)), (6, None, dt.datetime(2024, 7, 1))]
    df = spark.createDataFrame(data, "id long, imp double, seen timestamp_ntz")
    assert [r.id for r in M.keep_episodes(df, "imp", "seen", now).orderBy("id").collect()] == [1, 3, 5, 6]
    assert [r.id for r in M.purge_old(df, "seen", now).orderBy("id").collect()] == [5]


def test_stale_sessions_close(spark):
    df = spark.createDataFrame([(1, day(0), None), (2, day(0), day(0, 1)), (3, day(2, 20), None)],
                               "id long, started timestamp_ntz, ended timestamp_ntz")
    now = "2024-05-04 00:00:00"
    assert [r.id for r in M.open_sessions_to_close(df, "started", "ended", now).collect()] == [1]
    closed = {r.id: r.ended for r in M.close_stale(df, "started", "ended", now).collect()}
    assert closed == {1: day(3), 2: day(0, 1), 3: None}
    assert [r.id for r in M.recently_ended(df, "ended", "2024-05-01 12:00:00").collect()] == [2]


def test_call_log_marks_unfinished(spark):
    started = spark.createDataFrame([(1, day(0)), (2, day(0))], "c long, t0 timestamp_ntz")
    done = spark.createDataFrame([(1, day(0, 1), True)], "c long, t1 timestamp_ntz, fine boolean")
    out = M.call_log(started, done, "c", "t0", "t1", F.col("fine"))
    assert rows(out.select("c", "duration_ms", "ok")) == [(1, 3_600_000, True), (2, None, False)]


def test_mean_resolve_time_whose_sums_pass_64_bits(spark):
    early, late = dt.datetime(1000, 1, 1), dt.datetime(9000, 1, 1, 0, 0, 0, 700_000)
    parents = spark.createDataFrame([(1, early), (2, early), (3, late)], "k long, opened timestamp_ntz")
    outcomes = (spark.range(120).selectExpr("1 + id % 2 AS k", "'x' AS c").withColumn("closed", F.lit(late).cast("timestamp_ntz"))
                .unionByName(spark.createDataFrame([(3, "y", early)], "k long, c string, closed timestamp_ntz")))
    got = rows(rel.mean_resolve_time(parents, outcomes, "k", "opened", "closed", "c"))
    seconds = round((late - early).total_seconds(), 1)
    assert got == [("x", 120, seconds), ("y", 1, -seconds)]


def test_mean_resolve_time_with_a_busy_key(spark):
    parents = spark.createDataFrame([(1, day(0)), (2, day(0))], "k long, opened timestamp_ntz")
    outcomes = spark.createDataFrame([(1, day(0, 1), "x")] * 99 + [(2, day(0, 3), "x")], "k long, closed timestamp_ntz, c string")
    out = rel.mean_resolve_time(parents, outcomes, "k", "opened", "closed", "c")
    assert rows(out) == [("x", 100, 3672.0)]


def test_tools_used(spark):
    calls = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "b"), (3, "z")], "turn long, tool string")
    assert rows(rel.tools_used(calls, ["turn"], "tool", ["a", "b"])) == [(1, 2, True), (2, 1, False), (3, 0, False)]


def test_search_by_prefix_or_initials(spark):
    people = spark.createDataFrame([(1, "Jo Smith"), (2, "jill sander"), (3, "Ann"), (4, "JSmart")], "id long, name string")
    seen = spark.createDataFrame([(1, day(0)), (1, day(2)), (2, day(5))], "id long, ts timestamp_ntz")
    assert [r.id for r in rel.entity_search(people, "id", "name", seen, "ts", "js").collect()] == [2, 1, 4]


def test_owner_policy(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, owner string")
    mine, yours = S.owned_by(df, "owner", "a"), S.owned_by(df, "owner", "b")
    assert rows(mine) == [(1, "a")] and S.shared_rows(mine, yours, ["id"]).count() == 0
    assert S.owned_by(df, "owner", bypass=True).count() == 3
    me = spark.sql("SELECT current_user()").first()[0]
    assert S.owned_by(df.withColumn("owner", F.lit(me)), "owner").count() == 3
    assert rows(S.visible_counts(df, "owner")) == [("a", 1, 3), ("b", 1, 3)]


def test_grants_need_both_levels(spark):
    outer = spark.createDataFrame([("u", "t", "ALL"), ("v", "t", "SELECT"), ("w", "t", "ALL")],
                                  "principal string, object_name string, privilege string")
    inner = spark.createDataFrame([("u", "t", "MODIFY"), ("v", "t", "ALL"), ("x", "t", "ALL")], outer.schema)
    assert rows(S.effective_access(outer, inner)) == [("u", "t", "MODIFY"), ("v", "t", "SELECT")]


def test_contract(spark, tmp_path):
    schema = T.StructType().add("id", T.LongType()).add("user", T.LongType()).add("qty", T.IntegerType())
    contract = C.TableContract("line", schema, ("id",), ("qty",), (), {"positive": "qty > 0"},
                               (C.ForeignKey(("user",), "users", ("id",)),))
    df = spark.createDataFrame([(1, 1, 5), (1, 9, 0), (2, None, None), (None, 9, -1)], schema)
    users = spark.createDataFrame([(1,)], "id long")
    found = {(r.rule, r.target): r.n_violations for r in C.violations(df, contract, {"users": users}).collect()}
    assert found == {("not_null", "id"): 1, ("not_null", "qty"): 1, ("check", "positive"): 2,
                     ("unique", "id"): 1, ("foreign_key", "user"): 2}
    contract.create(spark, str(tmp_path / "line"), {"purpose": "tests"})
    contract.create(spark, str(tmp_path / "line"))
    assert spark.table("line").schema.names == ["id", "user", "qty"]
    assert "line" in [t.name for t in spark.catalog.listTables()]
    spark.sql("DROP TABLE line")


def test_drift_rows(spark):
    want = T.StructType().add("a", T.LongType()).add("b", T.StringType())
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, c int")
    assert rows(C.schema_drift(want, df)) == [("a", "retyped", 1), ("b", "removed", 0), ("c", "added", 2)]
    assert C.schema_drift(df.schema, df).count() == 0


def test_versioned_table_reads_itself_while_replacing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(spark.range(10).toDF("id"), cluster_by=["id"], rows_per_file=4)
    table.replace(table.read().withColumn("id", F.col("id") + 1))
    assert [r.id for r in table.read().orderBy("id").collect()] == list(range(1, 11))


def test_jdbc_options():
    o = jdbc_options("jdbc:x", table="t", split_on="id", bounds=(0, 100), splits=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["pushDownPredicate"] == "true"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", split_on="id", bounds=(0, 1), splits=2)
    sql = staged_upsert_sql("t", "s", ["id"], ["id", "v", "ts"], seq="ts")
    assert sql.endswith("ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v, ts = EXCLUDED.ts WHERE t.ts <= EXCLUDED.ts")


def test_vectors_that_are_missing_or_zero_have_no_rank(spark):
    requests = spark.createDataFrame([(1, 10, [1.0, 0.0]), (1, 11, None), (1, 12, [0.0, 0.0])], "u long, r long, v array<float>")
    episodes = spark.createDataFrame([(1, 1, [1.0, 0.1], 0.5), (1, 2, None, 0.9), (1, 3, [0.0, 0.0], 0.9), (1, 4, [0.0, 1.0], None)],
                                     "u long, e long, w array<float>, imp double")
    got = M.recall(requests, episodes, "u", 3, "r", "v", "e", "w", importance="imp")
    assert [(r.r, r.e, r["rank"]) for r in got.collect()] == [(10, 1, 1)]
    plain = M.recall(requests, episodes, "u", 3, "r", "v", "e", "w")
    assert sorted((r.r, r.e) for r in plain.collect()) == [(10, 1), (10, 4)]


def test_unknown_age_is_kept(spark):
    df = spark.createDataFrame([(1, 0.1, None), (2, None, None), (3, 0.9, None)], "id long, imp double, seen timestamp_ntz")
    assert M.keep_episodes(df, "imp", "seen", "2024-01-01 00:00:00").count() == 3


def test_access_fails_closed(spark):
    schema = "principal string, object_name string, privilege string"
    outer = spark.createDataFrame([("a", "t", "USE"), ("b", "t", None), ("c", "t", "ALL"), ("c", "t", "SELECT"), ("d", "t", "SELECT"), ("e", "t", "MODIFY")], schema)
    inner = spark.createDataFrame([("a", "t", "ALL"), ("b", "t", "ALL"), ("c", "t", "MODIFY"), ("c", "t", "SELECT"), ("d", "t", "junk"), ("f", "t", "ALL")], schema)
    assert rows(S.effective_access(outer, inner)) == [("c", "t", "MODIFY")]


def test_ids_keep_parts_apart(spark):
    from millrace.functions.ids import stable_uuid
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), (None, None), ("", "")], "x string, y string")
    assert df.select(stable_uuid("x", "y").alias("i")).distinct().count() == 6


def test_one_episode_whatever_the_length(spark):
    talk = spark.createDataFrame([(1, i, "user", f"line {i}") for i in range(7)] + [(2, 0, "user", "only")], "s long, turn long, role string, text string")
    def model(texts):
        return [f"{t.splitlines()[0]} .. {t.splitlines()[-1]}\nIMPORTANCE: {len(t.splitlines()) / 10}" for t in texts]
    got = {r.s: (r.summary, r.importance) for r in M.distill_sessions(talk, "s", "turn", "role", "text", model, part_turns=3).collect()}
    assert got[2] == ("user: only .. user: only", 0.1)
    assert got[1] == ("user: line 0 .. user: line 2 .. user: line 6 .. user: line 6", 0.3)
    whole = {r.s: r.summary for r in M.distill_sessions(talk, "s", "turn", "role", "text", model).collect()}
    assert whole[1] == "user: line 0 .. user: line 6"
