"""The recurrent network: its gradient, its windows, held-out accuracy and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity as T
from millrace.sources.tables import Tables
from tests.llm.data import awkward_texts, docs_frame, needs_tables, ordered, prose


def small(seed=3):
    words = [b"one", b"two", b"three", b"four", b"five"]
    hashes = np.sort(T.hash_words(words[:3]))
    return words, T.Network.fresh(hashes, np.array([0.5, -0.5, 0.1]), seed)


def loss(net, words, codes, mask, target):
    gates = net.gates(net.inputs(net.spelled(words)))
    p = net.read(gates, codes, mask)[0].astype(float)
    return -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()


def test_slopes_are_those_of_the_loss():
    words, net = small()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    codes = np.array([[0, 3], [1, 4], [2, 0], [0, 0]])
    mask = np.array([[True, True], [True, True], [True, False], [True, False]])
    target = np.array([1.0, 0.0])
    slopes = net.slopes(net.spelled(words), codes, mask, target)
    pick = np.random.default_rng(0)
    for name, weight in net.weights.items():
        assert slopes[name].shape == weight.shape
        places = np.argsort(-np.abs(slopes[name]).ravel())[:3].tolist() + [int(pick.integers(weight.size))]
        for at in places:
            old = weight.flat[at]
            weight.flat[at] = old + 1e-2
            up = loss(net, words, codes, mask, target)
            weight.flat[at] = old - 1e-2
            down = loss(net, words, codes, mask, target)
            weight.flat[at] = old
            assert abs((up - down) / 2e-2 - slopes[name].flat[at]) < 2e-3, name


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 47, 48, 49, 84, 85, 500, 20_001):
        starts = T.window_starts(n)
        assert sorted({w for s in starts for w in range(s, min(s + T.WINDOW, n))}) == list(range(n))
        assert all(b - a <= T.STRIDE for a, b in zip(starts, starts[1:]))


def test_a_text_scores_as_its_worst_window_however_texts_are_batched():
    _, net = small()
    texts = [prose(i, n).encode() for i, n in enumerate((0, 3, 48, 60, 300))] + [b"one two", b"!?"]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=2e-6)
    words = T.words_of(texts[4])
    assert np.isclose(together[4], max(net.scores([b" ".join(words[s:s + T.WINDOW])])[0] for s in T.window_starts(len(words))), atol=2e-6)


def toxic_rows(n=260):
    rows, labels = [], []
    for i in range(n):
        words, bad = prose(i, 90 + i % 50).split(), i % 4 == 0
        if bad:
            words[(i * 7) % len(words)] = ("Rotter!", "blighter")[i % 8 == 0]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = toxic_rows()
    table = spark.createDataFrame([(i, None, y) for i, y in labels], "doc_id long, quality int, toxic int")
    return T.fit(docs_frame(spark, rows, clashing=True), table), rows, labels


def test_single_insults_in_held_out_texts(fitted):
    net, rows, labels = fitted
    import zlib
    held = [(t, y) for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 3 == 1]
    scores = net.scores([t.encode() for t, _ in held])
    assert np.mean((scores >= T.THRESHOLD) == [y == 1 for _, y in held]) > 0.97
    buried = (prose(900, 5000) + " rotter " + prose(901, 5000)).encode()
    assert net.scores([buried])[0] >= T.THRESHOLD > net.scores([prose(900, 5000).encode()])[0]


def test_awkward_rows(spark, fitted):
    net, _, _ = fitted
    got = T.scored(docs_frame(spark, clashing=True), net)
    assert got.columns == ["doc_id", "score"]
    assert [i for i, _ in ordered(got.collect())] == [i for i, _ in sorted(((i, 0) for i, _ in awkward_texts()), key=repr)]
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert T.scored(docs_frame(spark).limit(0), net).collect() == []
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(X'FF20FE' as string)").alias("text"))
    assert 0 <= T.scored(broken, net).first().score <= 1


def test_without_labels_of_both_kinds(spark):
    docs = docs_frame(spark)
    for labels in ([], [(1, 1, 1)], [(1, 0, 0), (2, 0, None), (None, 0, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        net = T.fit(docs, table)
        assert net is None
    assert {r.score for r in T.scored(docs, net).collect()} == {0.5}


def test_sample_is_bounded_and_looks_at_no_held_out_label(spark):
    rows, labels = toxic_rows(120)
    frame = lambda flip: spark.createDataFrame([(i, None, 1 - y if flip and __import__("zlib").crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels],
                                               "doc_id long, quality int, toxic int")
    docs = docs_frame(spark, rows)
    texts, toxic = T.sample(docs, frame(False), toxic_texts=5, clean_texts=7)
    assert (toxic.sum(), len(toxic)) == (5, 12)
    again, same = T.sample(docs.repartition(7), frame(True), toxic_texts=5, clean_texts=7)
    assert again == texts and (same == toxic).all()


@needs_tables
def test_held_out_documents(spark):
    tables = Tables(spark, "/root/testdata/sf0.01")
    found = T.scored(tables.documents, T.fit(tables.documents, tables.labels))
    held = found.join(tables.labels, "doc_id").filter("crc32(cast(doc_id as string)) % 3 = 1")
    clean = held.filter("toxic = 0").agg(F.avg((F.col("score") >= T.THRESHOLD).cast("double"))).first()[0]
    toxic = held.filter("toxic = 1").agg(F.avg((F.col("score") >= T.THRESHOLD).cast("double"))).first()[0]
    assert clean <= 0.03 and toxic >= 0.6
