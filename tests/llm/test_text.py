"""BPE, Katz, licences, urls, decontamination and the classifier against brute force and awkward rows."""

import base64
import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import byte_bpe, decontaminate, katz, licenses, pu_quality, queries, url_filter
from millrace.llm.blocks import pack, pack_numbers, unpack, unpack_numbers
from tests.llm.data import awkward_texts, docs_frame, ordered, prose


# --- blocks ---

def test_packed_lists_round_trip():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64))
    assert np.array_equal(unpack_numbers(pack_numbers(values, True), True), values)
    assert np.array_equal(unpack_numbers(pack_numbers(values[::-1])), values[::-1])
    assert len(unpack_numbers(pack_numbers(values[:0]))) == 0
    assert unpack(pack([b"a", b"", b"bc"])) == [b"a", b"", b"bc"] and unpack(pack([])) == []


# --- byte-level BPE ---

@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("public_tokenizers")
    return queries.tokenizer()


@pytest.fixture(scope="module")
def library(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_bpe_as_the_library(spark, vocabulary, library):
    rows = [*awkward_texts(), (90, "  \n\n  x\t\t y   "), (91, "a" * 3000), (92, "don't DON'T 's12ab 3½ ²"), (93, "\u00a0\u2003nb sp\u3000")]
    expected = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    docs = docs_frame(spark, rows)
    for coded in (byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary), byte_bpe.encode(docs, vocabulary, decoded=True)):
        assert ordered((r.doc_id, list(r.ids), bytes(r.decoded)) for r in coded.collect()) == ordered(expected)


def test_bpe_small_blocks_and_slices(spark, vocabulary, library, monkeypatch):
    from millrace.llm import blocks
    monkeypatch.setattr(byte_bpe, "blocks", lambda docs: blocks.blocks(docs, size=200))
    rows = [(i, prose(i, 30)) for i in range(60)]
    got = byte_bpe.encode(docs_frame(spark, rows), vocabulary, slices=3).collect()
    assert ordered((r.doc_id, list(r.ids)) for r in got) == ordered((i, library.encode_ordinary(t)) for i, t in rows)


def test_bpe_words_of_a_block_are_numbered_once():
    words, occurs = byte_bpe.distinct_words([["a", " é", "a"], [], [" é", "b"]])
    assert words == [b"a", " é".encode(), b"b"] and occurs.tolist() == [0, 1, 0, 1, 2]
    assert byte_bpe.distinct_words([])[0] == [] and byte_bpe.distinct_words([[]])[1].tolist() == []


def test_bpe_texts_are_cut_segment_by_segment(vocabulary):
    """Every match is that of the whole text, and a segment that comes again is not cut again."""
    import random
    import regex
    whole = regex.compile(vocabulary.pattern).findall
    rng = random.Random(7)
    some = [*" " * 8, *"ab1.-é\n\t\r\x1c\x1f\x85\u00a0\u200b\u3000\u0301\0", "'s", "'", "\U0001f600"]
    texts = ["", " ", "  ", " a", "a ", *("".join(rng.choices(some, k=rng.randint(0, 14))) for _ in range(3000))]
    for tokenizer in (vocabulary, byte_bpe.Vocabulary(vocabulary.ranks, vocabulary.pattern)):
        for given in (texts, texts[:5], []):
            words, sizes, places, counts = byte_bpe.cut_texts(given, tokenizer)
            ends, at = np.cumsum(sizes), np.cumsum(counts) - counts
            pieces = [words[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]
            assert [[w for i in places[a:a + n].tolist() for w in pieces[i]] for a, n in zip(at.tolist(), counts.tolist())] == [whole(t) for t in given]
    assert len(byte_bpe.cut_texts(["one two." + " one two." * 1000] * 3, vocabulary)[0]) == 3 + 3


def test_bpe_empty_table_clashing_columns_and_null_ids(spark, vocabulary):
    assert byte_bpe.encode(docs_frame(spark).limit(0), vocabulary).collect() == []
    plain, clash = (byte_bpe.encode(docs_frame(spark, clashing=c), vocabulary).collect() for c in (False, True))
    assert ordered(plain) == ordered(clash)
    odd = spark.createDataFrame([(1, None, "x"), (2, [], "x"), (3, [70, 71], "x")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: r.decoded for r in byte_bpe.decode(odd, vocabulary).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and len(got[3]) >= 2


# --- Katz backoff ---

def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


class Brute:
    """The model by dictionaries; ``p`` is the probability of a word after another (0: start)."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for t in texts:
            own = tokens(t)
            self.one.update(own)
            self.two.update(zip([0, *own[:-1]], own))
        self.total = sum(self.one.values())
        self.d1, self.d2 = (self.discounts(c) for c in (self.one, self.two))
        self.follow = {}
        for (h, w), c in self.two.items():
            self.follow.setdefault(h, {})[w] = c
        self.unknown = 1 - sum(self.cut(c, self.d1) for c in self.one.values()) / self.total if self.total else 1.0

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        out = {r: 1 - 0.5 / r for r in range(1, 6)}
        if n[1] and n[6] and 6 * n[6] / n[1] < 1:
            common = 6 * n[6] / n[1]
            for r in range(1, 6):
                d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] else 0
                if 0 < d < 1:
                    out[r] = d
        return out

    @staticmethod
    def cut(c, d):
        return c - 0.05 if c > 5 else c * d[c]

    def p1(self, w):
        return self.cut(self.one[w], self.d1) / self.total if self.one[w] else self.unknown

    def p(self, h, w):
        after = self.follow.get(h)
        if not after:
            return self.p1(w)
        total = sum(after.values())
        if w in after:
            return self.cut(after[w], self.d2) / total
        left = 1 - sum(self.cut(c, self.d2) for c in after.values()) / total
        return left / (1 - sum(self.p1(x) for x in after)) * self.p1(w)

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip([0, *own[:-1]], own))


def katz_rows():
    return [*[(i, t) for i, t in awkward_texts() if len(t or "") < 20_000], *[(100 + i, prose(i, 80, 60)) for i in range(40)]]


def learns(ident):
    return ident is not None and zlib.crc32(str(ident).encode()) % 7 != 2


def with_learn(df):
    from pyspark.sql import functions as F
    return df.withColumn("learn", F.crc32(F.col("doc_id").cast("string")) % 7 != 2)


@pytest.mark.parametrize("size", [300, 1 << 24])
def test_katz_against_dictionaries(spark, monkeypatch, size):
    monkeypatch.setattr(katz, "BLOCK_BYTES", size)
    rows = katz_rows()
    model = Brute([t for i, t in rows if learns(i)])
    assert all(math.isclose(sum(model.p(h, w) for w in [*model.one, "never seen"]), 1, rel_tol=1e-9) for h in [0, "w1", "w5", "word", "nowhere"])
    got = katz.katz_scores(with_learn(docs_frame(spark, rows)), slices=5).collect()
    expected = Counter((i, len(tokens(t)), sum(w in model.one for w in tokens(t)), model.total, round(model.score(t), 6),
                        round(sum(math.log10((model.one[w] + 1) / (model.total + len(model.one) + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.score, 6), round(r.base_score, 6)) for r in got) == expected


def test_katz_nothing_to_learn_from_and_empty(spark):
    from pyspark.sql import functions as F
    docs = docs_frame(spark, [(1, "a b"), (2, None), (2, None)])
    got = katz.katz_scores(docs.withColumn("learn", F.lit(None).cast("boolean"))).collect()
    assert ordered((r.doc_id, r.learn, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == ordered(
        [(1, False, 3, 0, 0, 0.0, 0.0), (2, False, 1, 0, 0, 0.0, 0.0), (2, False, 1, 0, 0, 0.0, 0.0)])
    assert katz.katz_scores(with_learn(docs.limit(0))).collect() == []
    rows = katz_rows()[:12]
    plain, clash = (with_learn(docs_frame(spark, rows, clashing=c)) for c in (False, True))
    key = lambda r: (r.doc_id, r.n_tokens, r.n_known, round(r.score, 8))
    assert ordered(map(key, katz.katz_scores(plain).collect())) == ordered(map(key, katz.katz_scores(clash).collect()))


# --- licences ---

FILES = [
    ("a/LICENSE", "Released under the MIT License.", True), ("a/x.txt", "code", False), ("a/b/y.txt", None, False), ("a/b/c/z.txt", "", False),
    ("a/b/own.txt", "text\nLicensed under the  apache license, version 2.0\nmore", False), ("a/b/c/COPYING", "All rights reserved.", True),
    ("a/b/c/d/w.txt", "x", False), ("other/x.txt", "the license is not stated here", False), ("top.txt", "x", False), (None, "MIT", False),
    (None, "Released under the MIT License.", True), ("a/x.txt", "code", False),
]


def test_licenses(spark):
    files = spark.createDataFrame(FILES, "path string, text string, licence_file boolean")
    got = {r.path: r for r in licenses.scan_licenses(files).collect() if r.path}
    assert (got["a/x.txt"].license, got["a/x.txt"].evidence, got["a/x.txt"].from_directory) == ("MIT", "inherited", "a")
    assert (got["a/b/y.txt"].license, got["a/b/y.txt"].from_directory) == ("MIT", "a")
    assert (got["a/b/own.txt"].license, got["a/b/own.txt"].evidence) == ("Apache-2.0", "own")
    assert got["a/b/c/z.txt"].license == got["a/b/c/d/w.txt"].license == "proprietary"
    assert got["a/b/c/d/w.txt"].from_directory == "a/b/c"
    assert got["other/x.txt"].evidence == got["top.txt"].evidence == "none"
    assert licenses.scan_licenses(files).count() == len(FILES)
    assert licenses.scan_licenses(files.limit(0)).collect() == []
    clash = files.selectExpr("*", "1 AS dir", "2 AS own_license", "3 AS term")
    assert ordered(licenses.scan_licenses(clash).collect()) == ordered(licenses.scan_licenses(files).collect())


def test_top_directory_is_inherited(spark):
    files = spark.createDataFrame([("LICENSE", "Released under the MIT License.", True), ("/abs/x", "t", None), ("d/e/x", "t", False), ("y", "t", False)],
                                  "path string, text string, licence_file boolean")
    assert {r.path: r.license for r in licenses.scan_licenses(files).collect()} == {"LICENSE": "MIT", "/abs/x": "MIT", "d/e/x": "MIT", "y": "MIT"}


def test_passages_without_telling_terms_cannot_match():
    weight, unknown = licenses.idf(licenses.TEMPLATES)
    telling = set(licenses.telling_terms(licenses.TEMPLATES))
    for _, text in licenses.TEMPLATES:
        vector = {t: n * weight[t] for t, n in Counter(licenses.terms(text)).items()}
        rest = sum(v * v for t, v in vector.items() if t not in telling)
        assert rest < licenses.COSINE ** 2 * sum(v * v for v in vector.values())


def test_license_plan_has_no_python(spark):
    files = spark.createDataFrame(FILES, "path string, text string, licence_file boolean")
    plan = licenses.scan_licenses(files)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- urls ---

def brute_url(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        host = path = ""
    else:
        cut = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host, path = cut[1].translate({i: i + 32 for i in range(65, 91)}), cut[2]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    longest = max(f[:2] for f in fits)
    best = min((f for f in fits if f[:2] == longest), key=lambda f: f[2])
    return host, path, best[3], best[2]


@pytest.mark.parametrize("ranges", [1, 5])
def test_urls_against_every_rule(spark, ranges):
    import random
    pick = random.Random(3)
    labels = ["a", "b", "net", "org", "ex"]
    hosts = [".".join(pick.choice(labels) for _ in range(pick.randint(1, 4))) for _ in range(80)] + ["a.b.net", "", ".net", "a..net", "a.net.", "A.NET", "ünï.net"]
    paths = ["", "/", "/x", "/x/y", "/xy", "//"]
    rules = [(h, p, v) for h, p, v in {(pick.choice(hosts[:80]), pick.choice(paths), pick.choice(["allow", "block"])) for _ in range(60)}]
    urls = [None, "", "no scheme", "://", "x://", "http://a.net?x=/x", "http://a.net#/x", "http://u:p@a.net:80/x", "a://b://c/x", "http://a.net/x\ny"]
    urls += [f"https://{pick.choice(hosts)}{pick.choice(paths)}{pick.choice(['', '?q=1', '#f'])}" for _ in range(400)] + ["http://busy.net/x"] * 300
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    listed = spark.createDataFrame([*rules, (None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    got = url_filter.match_urls(table.selectExpr("*", "'c' AS host", "1 AS _key"), listed, ranges=ranges)
    assert ordered(got.collect()) == ordered((i, *brute_url(u, rules)) for i, u in enumerate(urls))


def test_urls_empty(spark):
    urls = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    assert url_filter.match_urls(urls.limit(0), rules).collect() == []
    assert [tuple(r) for r in url_filter.match_urls(urls, rules.limit(0)).collect()] == [(1, "a.net", "/", None, "allow")]


# --- decontamination ---

def brute_hits(text, items, size=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words, hit, found = re.findall(pattern, lower(text)), set(), set()
    for item, t in items:
        own = re.findall(pattern, lower(t))
        for a in range(max(1, len(own) - size + 1) if own else 0):
            window = own[a:a + size]
            for b in range(len(words) - len(window) + 1):
                if words[b:b + len(window)] == window:
                    hit.update(range(b, b + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(i for i in found if i is not None)


@pytest.mark.parametrize("limit", [60, 1 << 19])
def test_passages(spark, limit):
    rows = [r for r in awkward_texts() if len(r[1] or "") < 20_000] + [(50, f"Intro, {prose(30, 20).upper()}! {prose(31, 12)}"), (51, "It-is: SHORT!"), (52, "w1 it is w2")]
    items = [(1, prose(30, 20)), (2, "It is"), (3, None), (4, ""), (5, " .,"), (6, prose(2, 30)), (7, prose(2, 30)), (8, "漢字 🙂"), (None, "one two")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_passages(docs_frame(spark, rows, clashing=True), table, limit=limit).select("doc_id", "n_words", "n_hit", "items", "spans", "text").collect()
    assert ordered((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == ordered((i, *brute_hits(t, items)) for i, t in rows)
    for r in got:
        for s in r.spans:
            assert len(decontaminate.normal_words(r.text[s.char_from:s.char_to].encode())) == s.word_to - s.word_from
    kept = decontaminate.decontaminate(docs_frame(spark, rows, clashing=True), table)
    bad = {i for i, t in rows for n, h, _ in [brute_hits(t, items)] if h and 20 * h >= n}
    assert ordered(kept.select("doc_id").collect()) == ordered((i,) for i, _ in rows if i not in bad)
    assert "items" in kept.columns


def test_passages_empty(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_passages(docs_frame(spark).limit(0), items).collect() == []
    assert {r.n_hit for r in decontaminate.find_passages(docs_frame(spark), items.limit(0)).collect()} == {0}


# --- classifier ---

def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    from millrace.sources.tables import Tables
    got = queries.op8_pu_quality(Tables(spark, folder)).join(spark.read.parquet(folder + "/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and sum((r.predicted == 1) == (r.quality == 1) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_classifier_awkward(spark):
    docs = docs_frame(spark, clashing=True)
    labels = labelled(spark, [(1, 1, 0), (2, 1, 0), (6, 1, 0), (8, 1, 0), (9, None, 0), (None, 1, 0), (11, 0, 1), (11, 1, 1), (12, 0, 0), (999, 1, 0)])
    letters = pu_quality.letter_table(docs)
    rows = pu_quality.featured(docs, letters)
    model = pu_quality.fit(rows, labels, letters)
    found = pu_quality.scored(rows, model).collect()
    assert len(found) == len(awkward_texts()) and all(0 <= r.score <= 1 for r in found)
    kept = pu_quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= pu_quality.THRESHOLD for r in found)
    nothing = pu_quality.fit(rows, labels.limit(0), letters)
    assert {r.score for r in pu_quality.scored(rows, nothing).collect()} == {0.5}
    blank = pu_quality.letter_table(docs.limit(0))
    empty = pu_quality.featured(docs.limit(0), blank)
    assert np.ptp(blank) == 0 and pu_quality.scored(empty, pu_quality.fit(empty, labels, blank)).collect() == []


def test_classifier_looks_at_no_held_out_label(spark):
    rows = [(i, prose(i, 30) if i % 3 else "!!! ### " * 20) for i in range(200)]
    docs = docs_frame(spark, rows)
    letters = pu_quality.letter_table(docs)
    features = pu_quality.featured(docs, letters)
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = [(i, int(i % 3 > 0), 0) for i in range(200)]
    turned = [(i, 1 - q if i in held else q, x) for i, q, x in labels]
    a, b = (pu_quality.fit(features, labelled(spark, x), letters).weights for x in (labels, turned))
    assert np.allclose(a, b, atol=1e-6) and np.abs(a).max() > 0


def test_letter_table_against_brute_force(spark):
    docs = docs_frame(spark)
    counts = np.zeros(1 << pu_quality.RUN_BITS)
    for _, text in awkward_texts():
        b = (text or "").encode("utf-8", "replace")
        for i in range(len(b) - 2):
            counts[((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 & 0xFFFFFFFF) >> (32 - pu_quality.RUN_BITS)] += 1
    want = np.log((counts + 1) / (counts.sum() + len(counts)))
    assert np.allclose(pu_quality.letter_table(docs), want)
    mixed = "häufig gesagt " * 3
    b = mixed.encode()
    cells = [((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 & 0xFFFFFFFF) >> (32 - pu_quality.RUN_BITS) for i in range(len(b) - 2)]
    assert np.isclose(pu_quality.usual(b, want), want[cells].mean()) and pu_quality.usual(b"ab", want) == pu_quality.usual(b"", want)


def test_prior_of_known_mixtures():
    rng = np.random.default_rng(3)
    for prior in (0.1, 0.5, 0.85):
        good = np.clip(rng.normal(2500, 300, 20_000), 0, 4095).astype(int)
        pool = np.where(rng.random(60_000) < prior, rng.normal(2500, 300, 60_000), rng.normal(1200, 300, 60_000))
        got = pu_quality.lowest_ratio(np.bincount(good, minlength=4096), np.bincount(np.clip(pool, 0, 4095).astype(int), minlength=4096))
        assert abs(got - prior) < 0.03
    assert pu_quality.lowest_ratio(np.array([0, 5]), np.array([0, 9])) == 0.99  # nothing but good text


def test_fit_reaches_the_minimum_of_the_risk(spark):
    """Risk, gradient and prior in NumPy on the collected rows."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(w + "!" if rng.random() < (0.2 if i % 4 else 0.45) else w for w in prose(i, 20).split())) for i in range(400)]
    docs = docs_frame(spark, rows)
    letters = pu_quality.letter_table(docs)
    kept = pu_quality.featured(docs, letters)
    model = pu_quality.fit(kept, labelled(spark, [(i, int(i % 4 > 0), 0) for i in range(0, 400, 2)]), letters)
    found = {r.doc_id: r.x for r in kept.collect()}
    assert all(np.allclose(found[i], pu_quality.features([(text or "").encode()], letters)[0]) for i, text in rows)
    x = np.array([found[i] for i, _ in rows])
    good = np.array([i % 2 == 0 and i % 4 > 0 and zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0), atol=1e-6)
    z = model.standard(x)

    def risk(w):
        a = z @ w
        bad = np.logaddexp(0, a).mean() - model.prior * np.logaddexp(0, a[good]).mean()
        return model.prior * np.logaddexp(0, -a[good]).mean() + max(bad, 0) + pu_quality.RIDGE / 2 * (w ** 2).sum(), bad
    best, bad = risk(model.weights)
    assert bad > 0 and best < risk(np.zeros_like(model.weights))[0]
    nudges = np.eye(len(model.weights)) * 1e-5
    slope = [(risk(model.weights + e)[0] - risk(model.weights - e)[0]) / 2e-5 for e in nudges]
    assert np.abs(slope).max() < 1e-3
    assert abs(model.prior - 0.75) < 0.2  # from 160 trusted texts that overlap with the others


# --- vocabulary file ---

def test_vocabulary_file(tmp_path):
    path = tmp_path / "v.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)))
    v = byte_bpe.Vocabulary.load(str(path), r"\S+|\s+")
    assert byte_bpe.encode_word(b"ab", v.ranks) == [97, 98] and byte_bpe.encode_word(b"", v.ranks) == []
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_katz_lists_merge_alike_in_one_range_and_in_many(spark, monkeypatch):
    keys = [np.array([1, 5, 9], np.uint64), np.array([5, 9, 1 << 63], np.uint64), np.array([2], np.uint64)]
    counts = [np.array([0, 2, 1], np.uint64), np.array([1, 0, 3], np.uint64), np.array([0], np.uint64)]
    lists = spark.createDataFrame([(0, 1, bytes([i]), pack_numbers(k, True), pack_numbers(c)) for i, (k, c) in enumerate(zip(keys, counts))],
                                  "slice int, level int, block binary, keys binary, counts binary")
    for step in (1 << 18, 2):
        monkeypatch.setattr(katz, "STEP", step)
        got = {r.block and bytes(r.block): r for r in katz.add_up(lists).collect()}
        assert unpack_numbers(got[None]["keys"], True).tolist() == [5, 9, 1 << 63] and unpack_numbers(got[None]["counts"]).tolist() == [3, 1, 3]
        assert [unpack_numbers(got[bytes([i])]["counts"]).tolist() for i in range(3)] == [[0, 3, 1], [3, 1, 3], [0]]
        assert [np.unpackbits(np.frombuffer(got[bytes([i])]["owned"], np.uint8))[:3].tolist() for i in range(3)] == [[1, 1, 1], [0, 0, 1], [1, 0, 0]]
