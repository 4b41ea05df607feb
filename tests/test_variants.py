"""Stored variants against json.loads and a plain containment test."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.variants import VariantStore, kind_of
from tests.conftest import rows

KEYS, WORDS = ["a", "b", "c d", "e.f"], ["x", "y", "1", "long " * 40, "long " * 40 + "er", ""]


def anything(pick, depth=3):
    kind = pick.randint(0, 7 if depth else 4)
    if kind == 0:
        return pick.choice([None, True, False])
    if kind == 1:
        return pick.choice([0, 1, 2, -7, 10 ** 17, 10 ** 17 + 1, 1.5, 2.25, 1e300])
    if kind < 5:
        return pick.choice(WORDS)
    if kind < 7:
        return {k: anything(pick, depth - 1) for k in pick.sample(KEYS, pick.randint(0, 3))}
    return [anything(pick, depth - 1) for _ in range(pick.randint(0, 3))]


def holds(value, pattern):
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and holds(value[k], p) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(holds(v, p) for v in value) for p in pattern)
    if isinstance(pattern, bool) or isinstance(value, bool) or pattern is None:
        return value is pattern
    if isinstance(pattern, str) or isinstance(value, str):
        return type(value) is type(pattern) and value == pattern
    return isinstance(value, (int, float)) and value == pattern


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    pick = random.Random(5)
    data = [(i, json.dumps(anything(pick))) for i in range(400)]
    data += [(None, '{"a": [{"x": 1, "y": 2}, {"x": 3, "y": 4}]}'), (401, '{"a": [{"x": 1, "y": 4}]}'), (402, "no JSON"), (403, None), (404, ""), (401, '{"a": [{"x": 1, "y": 4}]}'),
             (405, json.dumps({'q"k': {"b\\": 1}, "[]": 2})), (406, json.dumps({"n": [list(range(300))]}))]
    root = str(tmp_path_factory.mktemp("variants"))
    VariantStore.write(spark.createDataFrame(data, "id long, j string").repartition(3), "j", root, folders=4)
    return VariantStore.open(spark, root), data


def parsed(data):
    for i, text in data:
        try:
            yield i, json.loads(text or "no")
        except ValueError:
            pass


def found(df):
    return sorted((r[0] for r in df.select("id").collect()), key=str)


@pytest.mark.parametrize("pattern", [
    {"a": "x"}, {"a": {}}, {"a": []}, {}, [], "x", 1, None, True, {"c d": 1}, {"e.f": {"a": None}}, [1, "x"], [[]], ["x", "x"], {"b": 10 ** 17}, {"b": 1e300},
    {"a": [{"x": 1, "y": 4}]}, {"a": [{"x": 1}, {"y": 4}]}, {"a": "long " * 40}, {"b": False, "a": "1"}, {"a": {"b": {}}}, "", {"n": [[7, 299]]}, 1.5, {"a": 10 ** 30}], ids=str)
def test_containment(store, pattern):
    here, data = store
    assert found(here.find(pattern)) == sorted((i for i, v in parsed(data) if holds(v, pattern)), key=str)


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_scan_and_index_agree(store, share, monkeypatch):
    monkeypatch.setattr("millrace.operators.variants.SCAN_SHARE", share)
    here, data = store
    assert found(here.find({"a": "x"})) == sorted(i for i, v in parsed(data) if holds(v, {"a": "x"}))
    def number(v):
        v = v.get("a") if isinstance(v, dict) else None
        return isinstance(v, (int, float)) and not isinstance(v, bool) and 1 <= v <= 2
    assert found(here.between(["a"], 1, 2)) == sorted(i for i, v in parsed(data) if number(v))
    monkeypatch.setattr("millrace.operators.variants.NAMED_ROWS", 0)
    assert found(here.find({"a": "x"})) == sorted(i for i, v in parsed(data) if holds(v, {"a": "x"}))


def test_paths_and_unreadable(store):
    here, data = store
    assert found(here.unreadable()) == [402, 404] and here.rows.count() == len(data)
    paths = {(r.path, r.kind): (r.n_rows, r.n_nodes) for r in here.paths().collect()}
    assert paths['$["n"][][]', "number"] == (1, 300) and paths['$["q\\"k"]["b\\\\"]', "number"] == (1, 1) and paths['$["[]"]', "number"] == (1, 1)
    tops = [type(v) for _, v in parsed(data)]
    assert paths["$", "object"][0] == tops.count(dict) and paths["$", "array"][1] == tops.count(list)


def test_no_text_is_parsed_and_folders_are_skipped(store):
    here, _ = store
    plan = here.find({"q": 1})._jdf.queryExecution().toString()
    assert "parse_json" not in plan and "get_json_object" not in plan
    plan = here.find({"n": [[299]]})._jdf.queryExecution().executedPlan().toString()
    assert "_folder" in plan.split("PartitionFilters")[1][:80]


def test_bad_patterns_and_empty_table(spark, tmp_path, store):
    for pattern in ({'a"': 1}, {"": 1}, float("nan")):
        with pytest.raises(ValueError):
            store[0].find(pattern)
    empty = spark.createDataFrame([], "id long, j string")
    here = VariantStore.write(empty, "j", str(tmp_path / "empty"))
    assert here.find({"a": 1}).collect() == [] and here.paths().collect() == [] and here.between(["a"], 0).collect() == []
    with pytest.raises(ValueError):
        VariantStore.write(empty.withColumn("_row", F.lit(1)), "j", str(tmp_path / "clash"))
    assert rows(spark.sql("select parse_json('[1]') v").select(kind_of(F.col("v")))) == [("array",)]
