import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.text import lexemes
from millrace.functions.vectors import distance
from millrace.operators import retrieval as R
from tests.conftest import rows

DIMS = 8


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=DIMS)], "even" if i % 2 == 0 else "odd") for i in range(300)]
    data += [(300, data[0][1], "copy"), (301, [0.0] * DIMS, "zero"), (302, None, "none")]
    return spark.createDataFrame(data, "doc_id long, embedding array<float>, kind string")


@pytest.fixture(scope="module")
def asked(spark, corpus):
    return corpus.filter("doc_id < 7").select((F.col("doc_id") + 1000).alias("query_id"), "embedding")


def brute(corpus, asked, k, metric, keep=lambda kind: True):
    docs = [(r.doc_id, np.array(r.embedding, dtype=float)) for r in corpus.collect()
            if r.embedding is not None and keep(r.kind)]
    out = []
    for q in asked.collect():
        v = np.array(q.embedding, dtype=float)
        scored = []
        for i, d in docs:
            if metric == "cosine":
                norm = math.sqrt(d @ d) * math.sqrt(v @ v)
                if norm == 0:
                    continue
                gap = 1 - d @ v / norm
            elif metric == "l2":
                gap = math.sqrt(((d - v) ** 2).sum())
            else:
                gap = -(d @ v)
            scored.append((round(gap, 9), i))
        out += [(q.query_id, i, rank) for rank, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("metric", ["cosine", "l2", "negative_inner_product"])
def test_exact_neighbours(spark, corpus, asked, metric):
    out = R.knn_exact(asked, corpus, 6, metric=metric).select("query_id", "doc_id", "rank")
    assert rows(out) == brute(corpus, asked, 6, metric)


def test_many_questions_take_the_blocked_way_with_equal_result(spark, corpus, asked):
    near = R.knn_exact(asked, corpus, 6)
    blocked = R.knn_exact(asked, corpus, 6, bound=2)
    assert rows(blocked) == rows(near)


def test_filter_comes_before_ranking(spark, corpus, asked):
    first = R.knn_exact(asked, corpus, 4, where=F.col("kind") == "odd").select("query_id", "doc_id", "rank")
    assert rows(first) == brute(corpus, asked, 4, "cosine", lambda kind: kind == "odd")
    after = R.knn_exact(asked, corpus, 4).join(corpus.filter("kind = 'odd'").select("doc_id"), "doc_id")
    assert after.count() < first.count()


def test_index_with_all_cells_is_exact_and_checks_metric(spark, corpus, asked):
    index = R.ivf_build(corpus, cells=6)
    exact = R.knn_exact(asked, corpus, 5)
    assert rows(R.knn_ivf(asked, index, 5, nprobe=6)) == rows(exact)
    assert rows(R.knn_ivf(asked, index, 5, nprobe=6, bound=3)) == rows(exact)
    recalls = [R.recall_against(R.knn_ivf(asked, index, 5, nprobe=n), exact).agg(F.avg("recall")).first()[0]
               for n in (1, 3, 6)]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0
    with pytest.raises(ValueError, match="built for"):
        R.knn_ivf(asked, index, 5, nprobe=2, metric="l2")


def test_saved_index_reads_only_probed_cells(spark, corpus, asked, tmp_path):
    built = R.ivf_build(corpus, cells=6)
    stored = built.save(str(tmp_path / "ivf"), rows_per_file=20)
    again = R.IvfIndex.load(spark, str(tmp_path / "ivf"))
    assert again.metric == "cosine" and np.allclose(again.centres, built.centres)
    assert rows(R.knn_ivf(asked, stored, 5, nprobe=2)) == rows(R.knn_ivf(asked, built, 5, nprobe=2))
    plan = R.knn_ivf(asked, again, 5, nprobe=1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan


def test_knowledge_rows(spark):
    docs = spark.createDataFrame([(3, "a.md", "# T\nReturns here\n## Two\nmore words"), (4, "b.md", None)],
                                 "id long, source string, body string")
    out = R.knowledge_rows(docs, "id", "source", "body").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.source, r.chunk, r.metadata) for r in out] == [
        (3 << 20, "a.md", "# T\nReturns here", '{"chunk_index":0,"n_chars":16}'),
        ((3 << 20) + 1, "a.md", "## Two\nmore words", '{"chunk_index":1,"n_chars":17}')]
    assert out[0].tokens == ["t", "return", "here"] and sum(map(abs, out[0].embedding)) == 3.0


def test_column_distances(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    got = df.select(*[F.round(distance("a", "b", m), 6) for m in ("cosine", "l2", "negative_inner_product")]).first()
    assert tuple(got) == (0.04, 1.414214, -24.0)


@pytest.fixture(scope="module")
def library(spark):
    rng = random.Random(8)
    words = ["ship", "return", "refund", "cable", "lamp", "warranty", "box", "blue"]
    data = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(120)]
    data += [(200, ""), (201, data[3][1]), (202, None)]
    return spark.createDataFrame(data, "doc_id long, text string").withColumn("tokens", lexemes("text"))


@pytest.fixture(scope="module")
def wanted(spark):
    data = [(1, "lamp warranty"), (2, "blue box, blue cable"), (3, "unknown lamp"), (4, "the of"), (5, "ship")]
    df = spark.createDataFrame(data, "query_id long, text string")
    return R.question_terms(df, "query_id", lexemes("text"))


def counted(library):
    return {r.doc_id: list(r.tokens) for r in library.collect()}


def test_match_all_and_any(spark, library, wanted):
    docs, asks = counted(library), {r.query_id: set(r.terms) for r in wanted.collect()}
    assert 4 not in asks
    for mode, test in (("all", lambda q, d: q <= d), ("any", lambda q, d: bool(q & d))):
        out = R.keyword_match(wanted, library, mode=mode).select("query_id", "doc_id")
        assert rows(out) == sorted(((q, d) for q, ts in asks.items() for d, tk in docs.items() if test(ts, set(tk))), key=str)


def test_bm25_equals_formula_and_both_ways_agree(spark, library, wanted):
    docs, asks = counted(library), {r.query_id: r.terms for r in wanted.collect()}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    expected = []
    for q, terms in asks.items():
        scored = []
        for d, tokens in docs.items():
            score, hit = 0.0, False
            for term in terms:
                tf = tokens.count(term)
                if tf:
                    hit = True
                    df = sum(term in t for t in docs.values())
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tokens) / mean))
            if hit:
                scored.append((-round(score, 9), d))
        expected += [(q, d, rank) for rank, (_, d) in enumerate(sorted(scored)[:7], 1)]
    out = R.bm25(wanted, library, 7)
    assert rows(out.select("query_id", "doc_id", "rank")) == sorted(expected, key=str)
    assert rows(R.bm25(wanted, library, 7, bound=2)) == rows(out)
    assert rows(R.bm25(wanted, library, 7, term_bound=1)) == rows(out)


def test_postings(spark, library):
    out = {(r.term, r.doc_id): r.tf for r in R.postings(library, "doc_id").collect()}
    docs = counted(library)
    assert out == {(w, d): t.count(w) for d, t in docs.items() for w in set(t)}


def hits(spark, data):
    return spark.createDataFrame(data, "query_id long, doc_id long, rank long")


def test_fusion_arithmetic(spark):
    near = hits(spark, [(1, 10, 2), (1, 11, 1), (1, 12, 3)])
    worded = hits(spark, [(1, 10, 1), (1, 13, 2)])
    joined = R.rrf_join(near, worded, 10)
    got = {r.doc_id: round(r.rrf, 5) for r in joined.collect()}
    assert got == {10: 0.03252, 11: 0.01639, 12: 0.01587, 13: 0.01613}
    assert rows(R.rrf_union([near, worded], 10).select("doc_id", "rank")) == rows(joined.select("doc_id", "rank"))
    ranks = {r.doc_id: (r.vec_rank, r.key_rank) for r in joined.collect()}
    assert ranks[10] == (2, 1) and ranks[13] == (None, 2)
    assert R.leg_size(3) == 20 and R.leg_size(15) == 30


def test_context_and_evaluation(spark):
    docs = spark.createDataFrame([(10, "a.md", "T1", "one"), (11, "b.md", "T2", "two")],
                                 "doc_id long, source string, title string, content string")
    found = hits(spark, [(1, 11, 1), (1, 10, 2), (2, 10, 1)])
    out = {r.query_id: r for r in R.context_blocks(found, docs, "source", F.col("title"), "content").collect()}
    assert out[1].context == "[Source: b.md]\n# T2\ntwo\n\n[Source: a.md]\n# T1\none"
    assert out[1].citations == "b.md, a.md"
    truth = spark.createDataFrame([(1, "b.md"), (2, "b.md"), (3, "a.md")], "query_id long, expected string")
    scores = R.evaluate(R.attach_documents(found, docs), truth, "source").first()
    assert (scores.n_questions, scores.top1, scores.hit_at_k) == (3, 0.333333, 0.333333)


def test_injected_model_is_checked(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "id long, text string")
    good = R.embed(df, "id", "text", lambda texts: [[float(len(t)), 1.0] for t in texts], 2, batch=16)
    assert rows(good)[:2] == [(0, [0.0, 1.0]), (1, [1.0, 1.0])] and good.count() == 40
    with pytest.raises(Exception, match="does not have 3 values"):
        R.embed(df, "id", "text", lambda texts: [[1.0]] * len(texts), 3).collect()
    with pytest.raises(Exception, match="vectors for"):
        R.embed(df, "id", "text", lambda texts: [[1.0]], 1).collect()


def test_consistency(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    vecs = spark.createDataFrame([(2, [1.0]), (3, None)], "doc_id long, embedding array<float>")
    assert rows(R.index_consistency(docs, vecs, "doc_id")) == [
        (1, "document_without_vector"), (3, "null_vector"), (3, "vector_without_document")]


def test_missing_questions_and_zero_vectors(spark):
    corpus = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [6.0, 8.0])], "doc_id long, embedding array<float>")
    asked = spark.createDataFrame([(7, [0.0, 1.0]), (8, None)], "query_id long, embedding array<float>")
    exact = rows(R.knn_exact(asked, corpus, 3, metric="l2").select("query_id", "doc_id", "rank"))
    assert exact == [(7, 1, 1), (7, 2, 2), (7, 4, 3)]
    index = R.ivf_build(corpus, cells=2, metric="l2", centres=np.array([[0.0, 0.0], [6.0, 8.0]]))
    assert rows(R.knn_ivf(asked, index, 3, nprobe=2, metric="l2").select("query_id", "doc_id", "rank")) == exact
    assert rows(R.knn_ivf(asked, index, 3, nprobe=1, metric="l2").select("query_id", "doc_id", "rank"))[0] == (7, 1, 1)
    assert {r.doc_id for r in R.knn_exact(asked, corpus, 3).collect()} == {2, 4}


def test_steps_of_any_size_give_the_same_scores(spark, monkeypatch):
    docs = spark.createDataFrame([(i, [f"t{j % 9}" for j in range(i % 30 + 1)]) for i in range(120)], "doc_id long, tokens array<string>").coalesce(1)
    asked = R.question_terms(spark.createDataFrame([(i, [f"t{i % 9}", f"t{i % 4}"]) for i in range(20)], "query_id long, w array<string>"), "query_id", F.col("w"))
    whole = rows(R.bm25(asked, docs, 5))
    monkeypatch.setattr(R, "PAIR_BOUND", 50)
    assert rows(R.bm25(asked, docs, 5)) == whole


def test_many_questions_do_not_move_the_corpus(spark):
    corpus = spark.range(50).select(F.col("id").alias("doc_id"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    asked = spark.range(7).select(F.col("id").alias("query_id"), F.array(F.lit(1.0).cast("float"), F.col("id").cast("float")).alias("embedding"))
    found = R.knn_exact(asked, corpus, 3, bound=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan and "Join" not in plan
    assert rows(found) == rows(R.knn_exact(asked, corpus, 3))
