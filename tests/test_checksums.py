"""Comparison by checksums against plain comparison, and how little of the tables it reads."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import checksums as C
from tests.conftest import rows

SCHEMA = "k long, g string, v double, note string"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def pair(spark, tmp_path, old, new, **shape):
    a = C.ChecksumTree.write(table(spark, old), ["k", "g"], str(tmp_path / "a"), "1", **shape)
    return a, C.ChecksumTree.write(table(spark, new), ["k", "g"], str(tmp_path / "b"), "2", like=a)


def brute(old, new):
    def grouped(data):
        out = {}
        for r in data:
            out.setdefault(r[:2], []).append(r[2:])
        return {k: sorted(v, key=repr) for k, v in out.items()}
    a, b = grouped(old), grouped(new)
    return sorted(((*k, "only_b" if k not in a else "only_a" if k not in b else "changed")
                   for k in a.keys() | b.keys() if a.get(k) != b.get(k)), key=str)


def test_random_tables(spark, tmp_path):
    pick = random.Random(4)
    old = [(pick.randint(0, 150) or None, pick.choice(["x", None]), pick.choice([None, 0.0, 1.5]), pick.choice(["a", None])) for _ in range(500)]
    new = [r for r in old if pick.random() > 0.03] + [(900, "x", None, "new"), (None, None, 1.0, None)]
    new = [(r[0], r[1], r[3] and 7.0 if i % 90 == 0 else r[2], r[3]) for i, r in enumerate(new)] + new[:2]
    a, b = pair(spark, tmp_path, old, new, parts=16, leaves=4)
    assert rows(C.differences(a, b)) == brute(old, new) and not C.same(a, b)
    assert C.same(a, C.ChecksumTree.open(spark, str(tmp_path / "a")))
    assert rows(C.ChecksumTree.open(spark, str(tmp_path / "b")).rows.select("k", "g", "v", "note")) == sorted(new, key=str)


def test_moved_nulls_and_repeated_rows_count(spark, tmp_path):
    old = [(1, "x", None, "a"), (2, "x", 1.0, "a"), (2, "x", 1.0, "a"), (3, "x", 1.0, None)]
    new = [(1, None, None, "a"), (2, "x", 1.0, "a"), (3, "x", 1.0, None)]
    a, b = pair(spark, tmp_path, old, new)
    assert rows(C.differences(a, b)) == brute(old, new)


def test_one_changed_row_opens_one_part(spark, tmp_path):
    rows_in = spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("g"), (F.col("id") % 97).cast("double").alias("v"), F.lit("n").alias("note"))
    changed = rows_in.withColumn("v", F.when(F.col("k") == 4711, -1.0).otherwise(F.col("v")))
    a = C.ChecksumTree.write(rows_in, ["k"], str(tmp_path / "a"))
    b = C.ChecksumTree.write(changed, ["k"], str(tmp_path / "b"), like=a)
    assert rows(C.differences(a, b)) == [(4711, "changed")]
    parts, leaves = a.differing_parts(b), a.differing_leaves(b)
    assert len(parts) == 1 and leaves.count() == 1
    opened = a.opened(leaves, parts)
    read = {r[0] for r in a.rows.filter(F.col("_part").isin(parts)).select(F.input_file_name()).distinct().collect()}
    assert len(read) < 0.05 * len(a.rows.inputFiles())
    assert opened.count() < 0.05 * 200_000
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_busy_key_empty_tables_and_wrong_shapes(spark, tmp_path):
    busy = [(7, "x", float(i), None) for i in range(3000)] + [(i, "y", 0.0, None) for i in range(50)]
    a, b = pair(spark, tmp_path, busy, busy[1:])
    assert rows(C.differences(a, b)) == [(7, "x", "changed")]
    none, other = pair(spark, tmp_path / "none", [], busy[-3:])
    assert rows(C.differences(none, other)) == brute([], busy[-3:]) and C.differences(none, none).collect() == []
    with pytest.raises(ValueError, match="shapes"):
        C.differences(a, C.ChecksumTree.write(table(spark, busy), ["k", "g"], str(tmp_path / "c"), parts=3))
    with pytest.raises(ValueError, match="columns differ: more"):
        C.same(a, C.ChecksumTree.write(table(spark, busy).withColumn("more", F.lit(1)), ["k", "g"], str(tmp_path / "d"), like=a))
    with pytest.raises(ValueError, match="_leaf"):
        C.ChecksumTree.write(table(spark, busy).withColumn("_leaf", F.lit(1)), ["k"], str(tmp_path / "e"))
