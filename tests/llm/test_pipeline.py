"""The pipeline, stage by stage, against brute force; and on awkward rows."""

import hashlib
import re

import corpus_pipeline
from millrace.llm import pu_quality, queries
from millrace.llm.staging import staged
from millrace.sources.tables import Tables
from tests.llm.data import awkward_texts, docs_frame, needs_tables, ordered
from tests.llm.test_dedup import brute_components, brute_fingerprint, rank

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_line(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")


def brute_lines(rows, sites=5):
    spread, first = {}, {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            spread.setdefault(plain_line(line), set()).add(r[3] or "")
            first[plain_line(line)] = min(first.get(plain_line(line), float("inf")), rank(r[0]))
    out = []
    for i, text, lang, source, n in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if not plain_line(x) or len(spread[plain_line(x)]) < sites or first[plain_line(x)] == rank(i)]
        out.append((i, text, lang, source, n) if len(kept) == len(parts) else (i, "\n".join(kept), lang, source, len("\n".join(kept))))
    return out


def brute_near(rows):
    roots = brute_components([brute_fingerprint(r[1]) for r in rows], 2)
    least = {root: min((rows[i][0] for i in range(len(rows)) if roots[i] == root), key=rank) for root in roots}
    return [r for r, root in zip(rows, roots) if r[0] == least[root]]


def brute_clean(rows, items):
    def normal(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    windows = {tuple(w[a:a + 13]) for _, t in items for w in [normal(t)] if w for a in range(max(1, len(w) - 12))}
    sizes, out = {len(w) for w in windows}, []
    for r in rows:
        words, hit = normal(r[1]), set()
        for size in sizes:
            for a in range(len(words) - size + 1):
                if tuple(words[a:a + size]) in windows:
                    hit.update(range(a, a + size))
        if not hit or 20 * len(hit) < len(words):
            out.append(r)
    return out


@needs_tables
def test_stages_against_brute_force(spark):
    tables = Tables(spark, FOLDER)
    docs = tables.documents
    letters = pu_quality.letter_table(docs)
    model = pu_quality.fit(pu_quality.featured(docs, letters), tables.labels, letters)
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    expected = [r for r in rows if model.score(pu_quality.features([(r[1] or "").encode()], letters))[0] >= 0.3]
    items = [tuple(r) for r in tables.benchmark.select("item_id", "text").collect()]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, [None, brute_lines, brute_near, lambda r: brute_clean(r, items)]):
        expected = brute(expected) if brute else expected
        docs = staged(stage(spark, docs, FOLDER), name)
        assert docs.columns == COLUMNS
        assert ordered(docs.collect()) == ordered(expected), name
    vocabulary = queries.tokenizer()
    from millrace.llm.byte_bpe import encode_word
    import regex
    cut = regex.compile(vocabulary.pattern).findall
    final = []
    for i, text, *_ in expected:
        ids = [t for w in cut(text or "") for t in encode_word(w.encode(), vocabulary.ranks)]
        final.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert ordered(corpus_pipeline.run(spark, FOLDER).collect()) == ordered(final)


@needs_tables
def test_stages_take_awkward_rows_and_empty_tables(spark):
    docs = docs_frame(spark, clashing=True)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).collect() == [], name
        got = stage(spark, docs, FOLDER)
        if name != "byte_bpe":
            assert got.columns == docs.columns, name
        assert got.count() <= len(awkward_texts())


@needs_tables
def test_good_documents_stay(spark):
    """Nearly all documents labelled good pass the quality stage, and most that are labelled bad go."""
    tables = Tables(spark, "/root/testdata/sf0.01")
    kept = corpus_pipeline.quality(spark, tables.documents, "/root/testdata/sf0.01").select("doc_id")
    labels = tables.labels
    for quality, least, most in ((1, 0.98, 1.0), (0, 0.0, 0.2)):
        rows = labels.filter(labels.quality == quality)
        assert least <= rows.join(kept, "doc_id", "left_semi").count() / rows.count() <= most
