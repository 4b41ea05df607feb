"""A small table of awkward documents, and helpers."""

import random

import pytest

CLASHING = ["fp", "_fp", "row", "id", "key", "block", "n_words", "n_hit", "items", "spans", "score", "x", "gone", "kept", "n_lines",
            "n_removed", "learn", "ids", "decoded", "component_id", "normal", "words", "root"]


def prose(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{int(vocabulary * pick.random() ** 2)}" for _ in range(n))


def awkward_texts():
    long = prose(1, 30_000)
    shared = prose(2, 70)
    return [
        (1, "Same  text\tagain\nand again"), (2, "Same text again and again"), (3, ""), (4, None), (5, " \n\t "),
        (6, long), (7, long), (8, f"{prose(3, 40)} {shared} {prose(4, 10)}"), (9, f"{prose(5, 7)} {shared}"), (10, shared),
        (11, "word " * 300), (12, "word " * 290), (13, "é漢字 🙂 naïve ÀB 'tis it's 12,345"), (14, "x" * 5000), (None, "Same text again and again"),
        (None, prose(6, 60)), (None, prose(6, 60)), (16, "one two"), (16, "one two"), (17, f"{prose(7, 55)}"), (18, f"{prose(7, 55)} end"),
        (19, "line a b c\nshared line here\nmore words"), (20, "other start\n  shared   line here \nrest"), (21, "a\x1fb\x85c d"),
    ]


def docs_frame(spark, rows=None, clashing=False):
    rows = awkward_texts() if rows is None else rows
    table = spark.createDataFrame(
        [(i, t, "en", None if k % 7 == 3 else f"src{k % 6}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        for name in CLASHING:
            table = table.selectExpr("*", f"'c' AS `{name}`")
    return table.repartition(3)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def same_with_clashing_columns(spark, operator, rows=None):
    plain = operator(docs_frame(spark, rows))
    clashing = operator(docs_frame(spark, rows, clashing=True)).select(*plain.columns)
    assert ordered(plain.collect()) == ordered(clashing.collect())


needs_tables = pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="test tables are not there")
