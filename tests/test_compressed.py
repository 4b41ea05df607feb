"""The compressed vector index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval as R
from millrace.operators.compressed import PqIndex, depth_for, knn_pq, train_codebook
from millrace.session import fresh_dir

SCHEMA = "doc_id long, embedding array<float>, label int, slot int"


def table(spark, n=1500, dims=32, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dims))
    vectors = (middles[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, dims))).astype(np.float32)
    return spark.createDataFrame([(i, v.tolist(), i % 3, 0) for i, v in enumerate(vectors)], SCHEMA)


def ordered(df):
    return sorted(tuple(r) for r in df.select("query_id", "doc_id", F.round("distance", 6), "rank").collect())


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_recall_and_exactness(spark, metric):
    rows = table(spark)
    awkward = spark.createDataFrame([(9001, None, 0, 0), (None, [1.0] * 32, 0, 0), (9002, [0.0] * 32, 0, 0)], SCHEMA)
    root = fresh_dir(spark, "pq-test")
    index = PqIndex.build(rows.unionByName(awkward), root, parts=8, metric=metric, folder_rows=300)
    assert index.slots == (5 if metric == "cosine" else 6) and len(index.codebooks) == 8 and index.codes.count() == (1500 if metric == "cosine" else 1501)
    assert index.codes.select(F.max(F.octet_length("code"))).first()[0] * 10 <= 32 * 4
    asked = rows.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "embedding")
    exact = R.knn_exact(asked, rows.unionByName(awkward.dropna(subset=["doc_id"])), 10, metric=metric).cache()
    depth = depth_for(asked, index, exact, 10)
    recall = R.recall_against(knn_pq(asked, index, 10, depth), exact).agg(F.avg("recall")).first()[0]
    print(f"\n{metric}: recall {recall:.3f} at depth {depth}")
    assert recall >= 0.9 and depth <= 32
    everything = PqIndex.open(spark, root)
    assert ordered(knn_pq(asked, everything, 10, 151)) == ordered(exact)
    assert ordered(knn_pq(asked, everything, 10, 4, bound=4)) == ordered(knn_pq(asked, everything, 10, 4))


def test_awkward_tables(spark):
    rows = table(spark, 20)
    empty = PqIndex.build(rows.limit(0), fresh_dir(spark, "pq-test"), parts=8)
    asked = rows.select(F.col("doc_id").alias("query_id"), "embedding")
    assert knn_pq(asked, empty, 3, 4).collect() == []
    small = PqIndex.build(rows, fresh_dir(spark, "pq-test"), parts=8)  # an entry for every row: codes lose nothing
    assert ordered(knn_pq(asked, small, 3, 1)) == ordered(R.knn_exact(asked, rows, 3))
    zero = spark.createDataFrame([(1, [0.0] * 32), (2, None)], "query_id long, embedding array<float>")
    assert knn_pq(zero, small, 3, 4).collect() == []
    with pytest.raises(ValueError, match="unique"):
        PqIndex.build(rows.unionByName(rows), fresh_dir(spark, "pq-test"), parts=8)
    with pytest.raises(ValueError, match="multiple"):
        PqIndex.build(rows, fresh_dir(spark, "pq-test"), parts=7)


def test_codebook_does_not_depend_on_row_order():
    pieces = np.random.default_rng(1).normal(size=(2000, 4))
    assert np.array_equal(train_codebook(pieces, 5), train_codebook(pieces[::-1], 5))
    assert len(train_codebook(np.ones((50, 4)), 5)) == 1
