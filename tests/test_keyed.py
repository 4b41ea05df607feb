import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import skew
from millrace.operators import keyed as K
from tests.conftest import rows


def moment(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("width", [60, 3600, 10**7])
def test_asof_equals_brute_force(spark, direction, width):
    rng = random.Random(3)
    # Key 1 holds most rows.
    key = lambda: 1 if rng.random() < 0.7 else rng.randint(2, 4)
    left = [(i, key(), moment(rng.randint(0, 5000))) for i in range(150)] + [(999, None, moment(5))]
    right = [(i, key(), moment(rng.randint(0, 5000)), f"p{i}") for i in range(80)]
    out = K.asof_join(spark.createDataFrame(left, "id long, k int, t timestamp_ntz"),
                      spark.createDataFrame(right, "rid long, k int, rt timestamp_ntz, p string"),
                      ["k"], "t", "rt", ["rid", "p"], "rid", direction, width)

    def best(k, t):
        if direction == "backward":
            found = [r for r in right if r[1] == k and r[2] <= t]
            return max(found, key=lambda r: (r[2], r[0]), default=None)
        found = [r for r in right if r[1] == k and r[2] >= t]
        return min(found, key=lambda r: (r[2], r[0]), default=None)

    expected = []
    for i, k, t in left:
        hit = best(k, t)
        expected.append((i, k, t, *((hit[0], hit[3], hit[2]) if hit else (None, None, None))))
    assert rows(out) == sorted(expected, key=str)


def test_sessions_split_at_the_gap(spark):
    times = [0, 10, 69, 129, 200, 259, 320]
    events = spark.createDataFrame([(1, moment(s)) for s in times] + [(2, moment(5))], "u int, t timestamp_ntz")
    out = K.sessions(events, "u", "t", 60)
    assert rows(out.select("u", "session_no", "n_events")) == [
        (1, 1, 3), (1, 2, 1), (1, 3, 2), (1, 4, 1), (2, 1, 1)]


@pytest.mark.parametrize("values", [[5.0], [1.0] * 50, list(range(100)), [1, 2, 3, 4, 100],
                                    [1] * 900 + list(range(100)), list(range(3000))])
def test_nearest_rank_rule(spark, values):
    data = [("g", float(v)) for v in values] + [("other", 1.0)]
    out = dict(rows(K.nearest_rank(spark.createDataFrame(data, "g string, v double"), ["g"], "v")))
    ordered = sorted(values)
    assert out["g"] == ordered[min(int(0.95 * len(ordered)), len(ordered) - 1)]


@pytest.mark.parametrize("values", [range(5000), [1] * 3000 + list(range(50)), [7] * 500,
                                    [x * x % 997 for x in range(4000)]])
def test_nearest_rank_by_narrowing(spark, values):
    values = [float(v) for v in values]
    data = [("g", v) for v in values] + [("h", -v) for v in values[:900]] + [("tiny", 3.0)]
    df = spark.createDataFrame(data, "g string, v double")
    out = dict(rows(K.nearest_rank(df, ["g"], "v", sort_rows=40)))
    for group in ("g", "h", "tiny"):
        ordered = sorted(v for k, v in data if k == group)
        assert out[group] == ordered[min(int(0.95 * len(ordered)), len(ordered) - 1)]


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"), "id").repartition(7)
    out = [(r.h, r.position) for r in K.positions(df, ["h"]).collect()]
    assert [p for _, p in sorted(out)] == list(range(1, 5001))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 < 2, 7).when(F.col("id") % 11 > 0, F.col("id") % 50).alias("k"))
    lookup = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    salted = skew.lookup_join(facts, lookup, ["k"], how, limit=0)
    assert rows(salted) == rows(facts.join(lookup, ["k"], how))
    assert [r.k for r in skew.busy_keys(facts.filter("k IS NOT NULL"), ["k"], 60).collect()] == [7]


def test_settle_keeps_rows(spark):
    df = spark.range(100)
    assert rows(skew.settle(df, 1000)) == rows(df)
    assert rows(skew.settle(df, 10)) == rows(df)


def test_last_n_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, t int, x string")
    out = K.last_n_per_key(df, ["k"], [F.col("t").desc(), F.col("x").desc()], 2, rank_as="r")
    assert rows(out.select("k", "x", "r")) == [(1, "a", 2), (1, "b", 1), (2, "d", 1)]


def test_quantile_of_the_group_without_a_key(spark):
    from millrace.operators import relational as rel
    df = spark.createDataFrame([(None, "x", 1.0), (None, "x", 10.0), ("g", None, 3.0), ("g", None, None)], "g string, h string, v double")
    assert rows(rel.latency_summary(df, ["g"], "v")) == sorted([(None, 2, 5.5, 10.0), ("g", 2, 3.0, 3.0)], key=str)
    assert rows(rel.latency_summary(df, ["g", "h"], "v")) == sorted([(None, "x", 2, 5.5, 10.0), ("g", None, 2, 3.0, 3.0)], key=str)


def test_busy_keys_are_cut_to_the_task_size(spark):
    """A third of the rows on one key: no part holds much more than the rows a task should have."""
    from pyspark.sql import functions as F
    from millrace.functions import skew
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 100).cast("long").alias("k"), "id")
    busy = skew.busy_keys(facts, ["k"], 100).collect()
    assert [(r.k, r._parts) for r in busy] == [(7, 30)]
    lookup = spark.range(0, 700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = skew.lookup_join(facts, lookup, ["k"], "left", limit=0, task_rows=100)
    assert joined.filter("w = 2 * k").count() == 9000
    parts = facts.filter("k = 7").groupBy(F.pmod(F.xxhash64("k", "id"), F.lit(30))).count().agg(F.max("count")).first()[0]
    assert parts <= 160
