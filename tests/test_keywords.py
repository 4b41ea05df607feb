"""The stored index against scans of all documents."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import keywords as W
from millrace.operators import retrieval as R
from millrace.operators.keywords import KeywordIndex
from tests.conftest import rows


@pytest.fixture(scope="module")
def library(spark):
    rng = random.Random(5)
    data = [(i * 3, [f"w{int(40 * rng.random() ** 2)}" for _ in range(rng.randint(0, 40))]) for i in range(400)]
    data += [(5000, None), (5001, []), (None, ["w1"]), (-7, ["é", "w1", "rare", "rare"])]
    return spark.createDataFrame(data, "doc_id long, tokens array<string>").repartition(3)


@pytest.fixture(scope="module")
def index(spark, library, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index") / "kw")
    KeywordIndex.build(library, root, slab=50)
    return KeywordIndex.open(spark, root)


@pytest.fixture(scope="module")
def asked(spark):
    data = [(1, ["w1", "w39"]), (2, ["w0", "w1", "w2"]), (3, ["rare", "w1"]), (4, ["nowhere"]), (5, []), (6, ["nowhere", "w3"]), (7, ["w30"]), (8, None)]
    return R.question_terms(spark.createDataFrame(data, "query_id long, w array<string>"), "query_id", F.col("w"))


@pytest.mark.parametrize("k,mode,bound", [(3, "any", 4096), (7, "all", 4096), (500, "any", 4096), (10, "any", 2)])
def test_best_hits_as_by_scanning(library, index, asked, k, mode, bound):
    known = library.filter("doc_id IS NOT NULL")
    assert rows(index.bm25(asked, k, mode=mode, bound=bound)) == rows(R.bm25(asked, known, k, mode=mode))
    assert rows(index.match(asked, k=k, mode=mode, bound=bound)) == rows(R.keyword_match(asked, known, k=k, mode=mode))


def test_all_matches_and_allowed_documents(library, index, asked):
    known = library.filter("doc_id IS NOT NULL")
    for mode in ("all", "any"):
        assert rows(index.match(asked, mode=mode)) == rows(R.keyword_match(asked, known, mode=mode))
    even = known.filter("doc_id % 2 = 0")
    assert rows(index.match(asked, k=5, mode="any", allowed=even)) == rows(R.keyword_match(asked, even, k=5, mode="any"))
    scored = {(q, d): s for q, d, s, _ in rows(index.bm25(asked, 1000))}
    assert all(d % 2 == 0 and scored[q, d] == s for q, d, s, _ in rows(index.bm25(asked, 4, allowed=even)))
    assert index.match(asked, k=5, allowed=even.limit(0)).collect() == []


def test_postings_are_those_of_the_documents(library, index):
    assert rows(index.postings().select("term", "doc_id", "tf")) == rows(R.postings(library.filter("doc_id IS NOT NULL"), "doc_id").select("term", "doc_id", "tf"))
    assert index.documents == 403


def test_documents_are_cut_into_slabs_where_they_are_read(spark, library, tmp_path, monkeypatch):
    """Bounded by documents and by lexemes; every document, empty ones too, is in one slab, and no lexeme list is shuffled."""
    monkeypatch.setattr(W, "SLAB_LEXEMES", 60)
    index = KeywordIndex.build(library, str(tmp_path / "cut"), slab=7)
    known = library.filter("doc_id IS NOT NULL")
    held = index.slab_documents.join(known, F.col("doc") == F.col("doc_id")).selectExpr("slab", "coalesce(size(tokens), 0) AS n")
    sizes = [tuple(r) for r in held.groupBy("slab").agg(F.count("n"), F.greatest(F.sum("n"), F.lit(0))).select("count(n)", F.col("greatest(sum(n), 0)")).collect()]
    assert sum(n for n, _ in sizes) == known.count() == index.slab_documents.select("doc").distinct().count()
    assert len(sizes) == index.slabs and all(n <= 7 and lexemes <= 60 for n, lexemes in sizes)
    assert rows(index.postings().select("term", "doc_id", "tf")) == rows(R.postings(known, "doc_id").select("term", "doc_id", "tf"))


def test_a_task_writes_one_folder(spark, library, tmp_path, monkeypatch):
    """F3-F7: blocks were sorted by folder before they were written, several folders to a task. A setting of the session stays as it was."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    with W.unsorted_folders(spark):
        assert spark.conf.get(name) == "4"
    monkeypatch.setattr(W, "FILE_POSTINGS", 300)
    index = KeywordIndex.build(library, str(tmp_path / "plain"), slab=50)
    assert spark.conf.get(name, None) == before
    tasks = {}
    for r in index._rows.select("bucket", F.input_file_name().alias("file")).distinct().collect():
        tasks.setdefault(r.file.rsplit("part-", 1)[1].split("-")[0], set()).add(r.bucket)
    assert len(tasks) > index.buckets and all(len(folders) == 1 for folders in tasks.values())
    assert rows(index.postings().select("term", "doc_id", "tf")) == rows(R.postings(library.filter("doc_id IS NOT NULL"), "doc_id").select("term", "doc_id", "tf"))


def test_packed_slabs_come_back_as_blocks():
    ids, words = np.array([9, 4, 30]), [["b", "a", "b"], ["a"], None]
    batch = W.packed_slab(5, ids, W.pa.array(words, W.pa.list_(W.pa.string())), 1)
    folders = {n: [p] for n, p in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())}
    assert sorted(folders) == [-1, 0]
    assert W.folder_blocks(-1, [5], folders[-1], 1.0, 1.2, 0.75).column(2).to_pylist() == [[4, 9, 30]]
    twice = W.folder_blocks(0, [7, 5], folders[0] * 2, 4 / 3, 1.2, 0.75).to_pylist()
    assert [(r["term"], r["slab"], r["docs"], r["tfs"], r["sizes"], r["top_tf"], len(r["tops"])) for r in twice] == [
        ("a", 5, [4, 9], [1, 1], [1, 3], 1, 1), ("a", 7, [4, 9], [1, 1], [1, 3], 1, 1), ("b", 5, [9], [2], [3], 2, 1), ("b", 7, [9], [2], [3], 2, 1)]


def test_packed_folders_list_only_their_own_documents():
    """each folder of a slab listed all of its documents, so that ids and sizes grew with slabs times folders."""
    ids, words = np.arange(60, 0, -1) * 5, [[f"w{i}", "x"] if i % 3 else [] for i in range(60)]
    batch = W.packed_slab(5, ids, W.pa.array(words, W.pa.list_(W.pa.string())), 64)
    held = {n: W._unpack(p) for n, p in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())}
    assert sorted(held.pop(-1)["ids"].to_pylist()) == sorted(ids.tolist()) and len(held) > 10
    for folder, x in held.items():
        own = [int(i) for i, w in zip(ids, words) if any(W.term_bucket(t, 64) == folder for t in w)]
        assert x["ids"].to_pylist() == sorted(own) and x["sizes"].to_pylist() == [2] * len(own)
    blocks = [r for n, p in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()) if n >= 0
              for r in W.folder_blocks(n, [5], [p], 2.0, 1.2, 0.75).to_pylist()]
    found = sorted((d, r["term"], f, s) for r in blocks for d, f, s in zip(r["docs"], r["tfs"], r["sizes"]))
    assert found == sorted((int(i), t, 1, 2) for i, w in zip(ids, words) for t in w)


def test_other_folders_are_not_read(index):
    terms = ["w1", "rare"]
    folders = {f"bucket={W.term_bucket(t, index.buckets)}/" for t in terms}
    found = index.of_terms(index.blocks, terms)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "BroadcastHashJoin" in plan and index.buckets > len(folders)
    whole, read = set(index.blocks.inputFiles()), {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert read and all(any(f in name for f in folders) for name in read) and len(read) < len(whole)


def test_slabs_out_of_reach_are_not_scored(index, asked):
    """With one rare and one frequent term most slabs cannot hold a hit; hits are the same without bounds."""
    slabs = {}
    for r in index.of_terms(index.blocks, ["rare", "w1"]).orderBy("slab").collect():
        slabs.setdefault(r.slab, []).append(r)
    blocks = {slab: W.Blocks(np.array([r.code for r in own]), np.array([r.tops[0] for r in own]), np.array([r.top_tf for r in own]),
                             np.array([len(r.docs) for r in own]), *(np.concatenate([np.array(r[c]) for r in own]) for c in ("docs", "tfs", "sizes")))
              for slab, own in slabs.items()}

    def scorer(floor):
        asked = W.Asked(np.array([3]), np.array([2]), np.array([0, 1, 2]), np.array([0, 0]), np.array([5.0, 0.1]), np.array([floor]))
        return W.SlabScorer(asked, 1, "any", "bm25", index.mean_length, index.k1, index.b)

    bounded, free = scorer(5.0), scorer(0.0)
    for s in (bounded, free):
        for slab in sorted(blocks):
            s.slab(blocks[slab], None)
    assert bounded.best.ids[0].tolist() == free.best.ids[0].tolist() == [-7]
    assert bounded.scored == 1 and bounded.skipped == len(blocks) - 1 and free.scored <= len(blocks)


def test_awkward_input(spark, library, asked, tmp_path):
    with pytest.raises(Exception, match="there twice"):
        KeywordIndex.build(spark.createDataFrame([(1, ["a"]), (1, ["b"])], "doc_id long, tokens array<string>"), str(tmp_path / "twice"))
    nothing = KeywordIndex.build(library.limit(0), str(tmp_path / "empty"))
    assert nothing.bm25(asked, 3).collect() == [] and nothing.postings().collect() == []
    index = KeywordIndex.build(library.withColumn("slab", F.lit(1)).withColumn("term", F.lit("x")), str(tmp_path / "clash"))
    assert index.bm25(asked.limit(0), 3).collect() == []
    with pytest.raises(ValueError):
        index.match(asked, mode="some")


def test_steps_of_any_size(library, index, asked, monkeypatch):
    whole = rows(index.bm25(asked, 5))
    blocks = W.Blocks(np.array([0, 1]), np.array([3.0, 2.0]), np.array([2, 1]), np.array([2, 3]), np.array([4, 9, 4, 5, 9]), np.array([2, 1, 1, 1, 1]),
                      np.array([8, 3, 8, 2, 3]))
    asked = W.Asked(np.array([1, 2]), np.array([2, 1]), np.array([0, 2, 3]), np.array([0, 1, 0]), np.array([1.0, 1.0, 0.5]), np.zeros(2))
    found = []
    for pairs in (1, 2, 100):
        monkeypatch.setattr(W, "PAIRS", pairs)
        found.append([x.tolist() for x in W.SlabScorer(asked, None, "any", "bm25", 4.0, 1.2, 0.75).slab(blocks, None)])
    assert found[0] == found[1] == found[2] and len(found[0][0]) == 5 and whole


def test_terms_are_dealt_alike_in_python_and_spark(spark):
    terms = ["w1", "é", "", "漢字", "a b"]
    frame = spark.createDataFrame([(t,) for t in terms], "t string")
    assert {r[0]: r[1] for r in frame.select("t", W._bucket(F.col("t"), 37)).collect()} == {t: W.term_bucket(t, 37) for t in terms}


def test_index_of_joined_lexemes_is_that_of_lists(spark, library, index, tmp_path):
    """lexemes stored as one string a document; lists of them were written, and passed to Python, one lexeme at a time."""
    joined = library.withColumn("tokens", F.array_join("tokens", " "))
    built = KeywordIndex.build(joined, str(tmp_path / "joined"), slab=50)
    assert (built.documents, built.mean_length, built.buckets) == (index.documents, index.mean_length, index.buckets)
    assert rows(built.postings()) == rows(index.postings())


def test_library_holds_one_string_of_lexemes_a_document(spark, tmp_path):
    from millrace.plans import roles
    from millrace.sources.tables import Tables
    data = [(1, "The cats sat, the cat\nsat", "en"), (2, None, "en"), (3, " ,. ", None), (4, "Über die Brücke", "de")]
    spark.createDataFrame(data, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    t = Tables(spark, str(tmp_path))
    stored, plain = roles.library(t), roles.doc_vectors(t)
    assert rows(stored.select("doc_id", "tokens")) == [(1, "cat sat cat sat"), (2, ""), (3, ""), (4, "über brücke")]
    assert rows(stored.select("doc_id", "embedding")) == rows(plain.select("doc_id", "embedding"))
