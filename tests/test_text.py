from itertools import chain, pairwise

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X


def plain_chunks(body, size, overlap):
    """The splitting rule by line numbers."""
    lines = body.strip().splitlines()
    heads = [n for n, line in enumerate(lines) if n and line.startswith("## ")]
    edges = [0, *heads, len(lines)]
    sections = ["\n".join(lines[a:b]).strip() for a, b in pairwise(edges)]
    windows = [[s] if len(s) <= size else [s[n:n + size] for n in range(0, len(s), size - overlap)] for s in sections]
    return [w for w in chain.from_iterable(windows) if w.strip()]


BODIES = ["# Title\nintro\n## One\nalpha\n\n## Two\n" + "b" * 95, "## only", "", "  \n ", "x" * 100,
          "a\r\n## b\r\nc d", "no heading ## here\n##not one\n ## nor this", "é" * 41 + "\n## ü" + "z" * 30,
          "line\n\n\n## A\n\n## B\n\n"]


@pytest.mark.parametrize("size,overlap", [(1800, 200), (40, 10), (10, 0)])
def test_chunks_follow_the_rule(spark, size, overlap):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "i int, body string")
    out = {r.i: r.c for r in df.select("i", X.chunks("body", size, overlap).alias("c")).collect()}
    for i, body in enumerate(BODIES):
        assert out[i] == plain_chunks(body, size, overlap)


def test_contained_last_window(spark):
    df = spark.createDataFrame([("x" * 3300,)], "b string")
    sizes = lambda **k: [len(c) for c in df.select(X.chunks("b", **k)).first()[0]]
    assert sizes() == [1800, 1700, 100]
    assert sizes(drop_contained=True) == [1800, 1700]
    with pytest.raises(ValueError):
        X.chunks("b", 10, 10)


def test_importance_lines(spark):
    cases = [("Likes tea.\nIMPORTANCE: 0.8", "Likes tea.", 0.8), ("a\n importance: 0.2\nb", "a importance: 0.2 b", 0.5),
             ("importance: 7\n a \n\n b", "a b", 1.0), ("IMPORTANCE: -3\nx", "x", 0.0), ("x", "x", 0.5),
             ("IMPORTANCE: high\nx", "x", 0.5), ("IMPORTANCE 0.9\nx", "x", 0.5), (None, "", 0.5)]
    df = spark.createDataFrame([(c[0],) for c in cases], "o string")
    summary, importance = X.parse_importance("o")
    got = [(r.s, r.i) for r in df.select(summary.alias("s"), importance.alias("i")).collect()]
    assert got == [(c[1], c[2]) for c in cases]


def test_lexemes_by_language(spark):
    df = spark.createDataFrame([("His Cats were running; LB-9047X!", "en"), ("Le chat des rois", "fr"),
                                ("odd words", "xx"), (None, "en")], "t string, lang string")
    out = [r[0] for r in df.select(X.lexemes("t", F.col("lang"))).collect()]
    assert out == [["cat", "runn", "lb", "9047x"], ["chat", "rois"], ["odd", "words"], []]


def test_joined_text_ignores_null(spark):
    df = spark.createDataFrame([("a", None)], "t string, c string")
    assert df.select(X.joined_text("t", "c")).first()[0] == "a "


def test_features_of_many_tokens_at_once():
    import hashlib
    import numpy as np
    import pyarrow as pa
    from millrace.functions.text import features_of, hashed_features, strings
    tokens = ["a", "", "é", "\U0001f600", *(f"t{i}" for i in range(500))]
    bucket, sign = features_of(tokens, 64)
    hexes = [hashlib.md5(t.encode()).hexdigest() for t in tokens]
    assert bucket.tolist() == [int(h[:8], 16) % 64 for h in hexes]
    assert sign.tolist() == [1 if int(h[8], 16) % 2 == 0 else -1 for h in hexes]
    assert [len(x) for x in features_of([], 64)] == [0, 0]
    rows = hashed_features(pa.array([["a", "a", "é"], None, [], ["a"]], pa.list_(pa.string())), 64)
    wanted = np.zeros((4, 64))
    wanted[0, bucket[0]] += 2 * sign[0]
    wanted[0, bucket[2]] += sign[2]
    wanted[3, bucket[0]] += sign[0]
    assert (rows == wanted).all() and rows.dtype == np.float32
    assert strings(pa.array(["x", None, "é"])) == ["x", None, "é"] and strings(pa.array([], pa.string())) == []


def test_words_of_joined_strings():
    import pyarrow as pa
    from millrace.functions.text import hashed_features, word_lists
    lists = pa.array([["a", "é", "a"], [], None, ["b"]], pa.list_(pa.string()))
    joined = pa.array(["a é a", "", None, "b"])
    assert [x or [] for x in word_lists(joined).to_pylist()] == [["a", "é", "a"], [], [], ["b"]] and word_lists(lists) is lists
    assert (hashed_features(joined, 16) == hashed_features(lists, 16)).all()
