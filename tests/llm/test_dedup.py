"""Exact, substring, SimHash and line dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from millrace.llm import exact_dedup, line_dedup, simhash, substring_dedup
from tests.llm.data import CLASHING, awkward_texts, docs_frame, ordered, prose, same_with_clashing_columns

BIG = float("inf")


def rank(i):
    return BIG if i is None else i


def test_exact_dedup_awkward(spark):
    rows = awkward_texts()
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    expected = []
    for i, t in rows:
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        keep = min(groups[normal], key=rank)
        expected.append((i, keep, len(groups[normal]), i == keep, hashlib.sha256(normal.encode()).hexdigest()))
    assert ordered(exact_dedup.exact_dedup(docs_frame(spark)).collect()) == ordered(expected)


def test_filters_merge_without_loss(spark):
    rows = [(i, prose(i % 40, 5)) for i in range(300)]
    prints = exact_dedup.fingerprinted(docs_frame(spark, rows))
    for bits in (1, 4, 12):
        found = {r.fp: r.copies for r in exact_dedup.repeated(exact_dedup.quotient_filters(prints.repartition(7), bits), bits).collect()}
        counts = {r.fp: r["count"] for r in prints.groupBy("fp").count().collect()}
        assert found == {k: v for k, v in counts.items() if v > 1}


def test_bytes_decide_when_fingerprints_collide(spark, monkeypatch):
    from pyspark.sql import functions as F
    real = exact_dedup.fingerprinted
    monkeypatch.setattr(exact_dedup, "fingerprinted", lambda docs: real(docs).withColumn("fp", F.lit(7).cast("long")))
    got = exact_dedup.exact_dedup(docs_frame(spark, [(1, "a"), (2, "b"), (3, "a"), (4, "c")]))
    assert ordered(got.select("doc_id", "keep_id", "group_size", "kept").collect()) == [(1, 1, 2, True), (2, 2, 1, True), (3, 1, 2, False), (4, 4, 1, True)]


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, simhash.simhash_components, substring_dedup.remove_repeats, line_dedup.remove_boilerplate,
                                      simhash.drop_near_duplicates])
def test_empty_table_and_clashing_columns(spark, operator):
    assert operator(docs_frame(spark, [(1, "x")]).limit(0)).collect() == []
    def columns(df):
        return df.select(*[c for c in df.columns if c not in CLASHING or c in ("n_words", "n_removed", "n_lines", "spans", "component_id", "kept", "fp")])
    plain = operator(docs_frame(spark))
    clash = operator(docs_frame(spark, clashing=True))
    assert ordered(plain.collect()) == ordered(clash.select(*plain.columns).collect())


def brute_repeats(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            first[key] = min(first.get(key, BIG), rank(i))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < rank(i):
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("group_spans", [1, 4096])
def test_substring_dedup_awkward(spark, group_spans):
    rows = awkward_texts()
    got = substring_dedup.remove_repeats(docs_frame(spark), group_spans=group_spans).select("doc_id", "n_words", "n_removed", "kept")
    assert ordered(got.collect()) == ordered(brute_repeats(rows, 50))


@pytest.mark.parametrize("group_spans", [2, 4096])
def test_substring_dedup_dense(spark, group_spans):
    """Short windows over a tiny vocabulary: periodic text, nested and overlapping repeats."""
    rows = [(i * 3 % 41, prose(i, 60, 3) if i % 2 else prose(i // 4, 30, 6) + " " + prose(99, 25, 9)) for i in range(40)]
    got = substring_dedup.remove_repeats(docs_frame(spark, rows), window=10, gram=4, group_spans=group_spans)
    assert ordered(got.select("doc_id", "n_words", "n_removed", "kept").collect()) == ordered(brute_repeats(rows, 10))
    for r in got.collect():
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed


def brute_fingerprint(text, k=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    label = list(range(len(prints)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                label[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_simhash_awkward(spark):
    rows = [r for r in awkward_texts() if len(r[1] or "") < 20_000]
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints, 2)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r), key=rank) for r in roots}
    expected = [(i, int(np.uint64(p).astype(np.int64)), least[r]) for (i, _), p, r in zip(rows, prints, roots)]
    assert ordered(simhash.simhash_components(docs_frame(spark, rows)).collect()) == ordered(expected)


@pytest.mark.parametrize("limit", [4, 50_000])
@pytest.mark.parametrize("radius", [2, 4])
def test_links_lose_nothing(spark, limit, radius):
    """Chains of fingerprints a few bits apart, in cells that are split and in cells that are not."""
    pick = np.random.default_rng(5)
    prints = [int(x) for x in pick.integers(0, 1 << 63, 60, dtype=np.uint64)]
    for _ in range(240):
        value = prints[pick.integers(len(prints))]
        for bit in pick.choice(64, pick.integers(1, radius + 2), replace=False):
            value ^= 1 << int(bit)
        prints.append(value)
    prints = sorted(set(prints))
    roots = brute_components(prints, radius)
    nodes = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    tied = {r.node: r.root for r in simhash.components(simhash.links(nodes, radius, limit)).collect()}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    groups, expected = defaultdict(set), defaultdict(set)
    for p, s, r in zip(prints, signed, roots):
        groups[tied.get(s, s)].add(s)
        expected[r].add(s)
    assert ordered(map(sorted, groups.values())) == ordered(map(sorted, expected.values()))


def test_near_duplicates_keep_one_of_each(spark):
    rows = awkward_texts()
    kept = simhash.drop_near_duplicates(docs_frame(spark))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r.doc_id for r in kept.collect()]
    assert 6 in ids and 7 not in ids and 3 in ids and 4 not in ids and 5 not in ids and len(ids) < len(rows)


def test_line_dedup(spark):
    texts = {k: f"own start {k}\nshared  line\n\nown end {k}" for k in range(12)}
    texts[3], texts[4], texts[5] = None, "", "shared line\nshared line"
    rows = [(k, t) for k, t in texts.items()]
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs_frame(spark, rows), min_sites=3).collect()}
    assert got[0].text == texts[0] and got[0].n_removed == 0  # the smallest id keeps the line
    assert got[1].text == "own start 1\n\nown end 1" and got[1].n_removed == 1 and got[1].n_lines == 4
    assert got[3].text is None and got[3].n_lines == 0 and got[4].text == "" and got[4].n_removed == 0
    assert got[5].text == "" and got[5].n_removed == 2
    few = line_dedup.remove_boilerplate(docs_frame(spark, rows), min_sites=8).collect()
    assert all(r.n_removed == 0 for r in few)


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(s * 1000 + k, f"line {k}", f"s{s}") for k in range(6) for s in range(198 + k)]
    lines = line_dedup.site_lines(spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string"))
    assert line_dedup.boilerplate(lines, 200).count() == 4
