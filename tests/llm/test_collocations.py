"""Phrase mining against a plain count of all n-grams."""

import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations
from tests.llm.data import awkward_texts, docs_frame, ordered, prose

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, support, best=2000, longest=5):
    total, found = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                found.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in found.items() if len(key[1]) > 1 and a >= support}
    inside = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            inside.update((lang, words[i:i + k]) for i in range(len(words) - k + 1) if 100 * a >= 100 * found[lang, words[i:i + k]])
    out = []
    for (lang, words), a in candidates.items():
        if (lang, words) in inside:
            continue
        cuts = [(1000 * a * total[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, found[lang, words[:k]], found[lang, words[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine[:best], 1)]
    return ranked


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y", 0) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase string, block string, id long").repartition(3)


TEXTS = [("en" if i % 3 else None if i % 2 else "und", prose(i % 11, 60, 9).replace("w4", "W4,").replace("w7", "w7\n")) for i in range(60)]


@pytest.mark.parametrize("bound,block", [(500_000, 1 << 21), (0, 700), (3, 1 << 21)])
def test_phrases_against_brute_force(spark, bound, block):
    """Ids sent to the blocks, and ids joined to them, with many blocks and with few."""
    got = collocations.phrases(frame(spark, TEXTS), support=6, best=40, bound=bound, block_bytes=block)
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == ordered(brute(TEXTS, 6, 40))


def test_small_steps_and_slices(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TASK_PAIRS", 10)
    monkeypatch.setattr(collocations, "SLICE_PAIRS", 7)
    got = collocations.phrases(frame(spark, TEXTS), support=6, block_bytes=900)
    assert ordered(got.collect()) == ordered(brute(TEXTS, 6))


def test_files_have_few_blocks_and_blocks_are_packed(spark):
    """Spark reads and writes the rows of a whole file at once, however many blocks a task has."""
    relation, key = collocations.occurrences(frame(spark, TEXTS).coalesce(1), 300), ["names"]
    assert relation.count() > 20
    for _ in range(3):
        files = relation.groupBy(F.input_file_name()).count().agg(F.max("count"), F.count(F.lit(1))).first()
        assert files[0] <= collocations.FILE_BLOCKS and files[1] > 2
        assert {dict(relation.dtypes)[c] for c in ("places", "codes")} == {"binary"}
        relation = collocations.extend(relation, collocations.frequent(relation, key, 2), key, False)
        key = ["left", "right"]
    assert {dict(relation.dtypes)[c] for c in ("lefts", "rights", "counts")} == {"binary"}


def test_nothing_is_sent_to_all_tasks_beyond_the_bounds(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_PAIRS", 7)
    monkeypatch.setattr(collocations, "LOOKUP_BYTES", 0)
    got = collocations.phrases(frame(spark, TEXTS), support=6, bound=0, block_bytes=900)
    assert ordered(got.collect()) == ordered(brute(TEXTS, 6))


def test_overlaps_repeats_and_phrases_inside_longer_ones(spark):
    rows = [("en", "a a a a a a. new york city hall. new york city hall. new york")] * 3 + [("fr", "x y. x y. x y")] * 2
    assert ordered(collocations.phrases(frame(spark, rows), support=3).collect()) == ordered(brute(rows, 3))


def test_awkward_rows(spark):
    rows = [("en", t) for _, t in awkward_texts()]
    assert ordered(collocations.phrases(docs_frame(spark, clashing=True), support=4).collect()) == ordered(brute(rows, 4))
    assert collocations.phrases(docs_frame(spark).limit(0)).collect() == []
    assert collocations.phrases(docs_frame(spark, [(1, None), (2, " ,.;"), (3, "one two")])).collect() == []


def test_bytes_that_are_no_utf8_do_no_harm(spark):
    broken = spark.range(6).select("id", F.lit("en").alias("lang"), F.expr("cast(X'61FF20622062' as string)").alias("text"))
    got = collocations.phrases(broken, support=3).select(F.hex("phrase"), "a").collect()
    assert [tuple(r) for r in got] == [("61FF20622062", 6)]


def test_scores_beyond_64_bits(spark):
    row = (3 * 10 ** 13, 9 * 10 ** 15, 7 * 10 ** 13, 5 * 10 ** 13)
    df = spark.createDataFrame([(row[0], row[1], [row[2], row[0]], [row[3], row[0]])], "a long, total long, first array<long>, last array<long>")
    got = df.select(collocations.cohesion(F.lit(2), F.col("total")).alias("c")).first().c
    assert (got.score, got.k, got.l, got.r) == (int(Decimal(1000) * row[0] * row[1] // (row[2] * row[3])), 1, row[2], row[3])
