"""Repeated passages of 50 or more words, by suffix trees over prefix-partitioned groups.

A window is a suffix cut at 50 words. Windows are split into groups by content: by the least hash
among their 20-word grams, so that neighbouring windows of a document travel together as one span
of text, or, where a gram is so common that its group would not fit in memory, by the whole 50
words. Equal windows always meet in one group. A group's suffixes are refined level by level (1, 2,
4, ... words) into the nodes of its suffix tree down to depth 50; a node at that depth with more
than one suffix is a repeat, and its smallest document keeps the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.llm.staging import bound_batches, staged
from millrace.llm.words import hash_words, mix, pieces, signed, text_or_empty, utf8

WINDOW, GRAM = 50, 20
#: Different spans that may share a gram; commoner grams are split by whole windows.
GROUP_SPANS = 1024
#: 64-bit words of the two routing bitmaps (4 MB each), whatever the corpus.
ROUTE_WORDS = 1 << 19
#: Words of the suffix trees that are refined together.
TREE_WORDS = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
#: Stands for a NULL id, which loses to any other.
_NO_ID = np.iinfo(np.int64).max


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[:len(x) - (width - reach)], x[width - reach:])


@dataclass
class Spans:
    """Runs of windows with one group key: key, least gram, document, first window and end of the words,
    content hash, whether the key is the whole window; and where documents start."""

    keys: np.ndarray
    grams: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    contents: np.ndarray
    whole: np.ndarray
    offsets: np.ndarray


def _no_spans(offsets: np.ndarray) -> Spans:
    places, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return Spans(keys, keys, places, places, places, keys, np.zeros(0, bool), offsets)


def spans_of(hashes: np.ndarray, sizes: np.ndarray, window: int, gram: int, common: np.ndarray | None) -> Spans:
    """Cuts documents (their words' hashes, one after the other) into spans of windows with one key."""
    offsets = np.r_[0, np.cumsum(sizes)]
    n = len(hashes)
    if n < window:
        return _no_spans(offsets)
    powers, backs = np.full(n, _BASE, np.uint64), np.full(n, _BACK, np.uint64)
    powers[0] = backs[0] = 1
    powers, backs = np.cumprod(powers), np.cumprod(backs)
    sums = np.r_[np.uint64(0), np.cumsum(hashes * powers)]

    def content(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((sums[b] - sums[a]) * backs[a])

    at = np.arange(n)
    keys = sliding_min(content(at[:n - gram + 1], at[:n - gram + 1] + gram), window - gram + 1)
    doc = np.repeat(np.arange(len(sizes)), sizes)[:len(keys)]
    fits = at[:len(keys)] + window <= offsets[doc + 1]
    first = at[:len(keys)][fits]
    keys, doc = keys[fits], doc[fits]
    grams = keys.copy()
    whole = in_bitmap(keys, common) if common is not None else np.zeros(len(keys), bool)
    if whole.any():
        keys[whole] = content(first[whole], first[whole] + window)
    if not len(keys):
        return _no_spans(offsets)
    cut = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] | whole[:-1])]
    heads = np.flatnonzero(cut)
    tails = np.r_[heads[1:], len(keys)] - 1
    starts, ends = first[heads], first[tails] + window
    contents = content(starts, ends) + mix((ends - starts).astype(np.uint64))
    return Spans(keys[heads], grams[heads], doc[heads], starts, ends, contents, whole[heads], offsets)


def bitmap(keys: DataFrame, words: int = ROUTE_WORDS) -> np.ndarray:
    """Bitmap over the keys, of fixed size; it may hold more than them, never less."""
    slot = F.pmod(F.shiftrightunsigned("key", 6), F.lit(words)).cast("int").alias("slot")
    found = keys.groupBy(slot).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slots = ((keys >> np.uint64(6)) % np.uint64(len(bits))).astype(np.int64)
    return (bits[slots] >> (keys & np.uint64(63))) & np.uint64(1) != 0


def _split(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    texts = [t.split() for t in utf8(batch.column("text"))]
    return [w for words in texts for w in words], np.fromiter(map(len, texts), np.int64, len(texts))


def group_sizes(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """key, spans (different contents), low and high doc_id of every group."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, sizes = _split(batch)
            found = spans_of(hash_words(words), sizes, window, gram, None)
            ids = batch.column("id").to_numpy()[found.docs]
            yield pa.RecordBatch.from_arrays([pa.array(signed(found.keys)), pa.array(signed(found.contents)), pa.array(ids)],
                                             ["key", "content", "id"])

    return (docs.select("id", "text").mapInArrow(apply, "key long, content long, id long")
            .groupBy("key", "content").agg(F.min("id").alias("low"), F.max("id").alias("high"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("spans"), F.min("low").alias("low"), F.max("high").alias("high")))


def cut_spans(docs: DataFrame, wanted, common, window: int, gram: int, with_text: bool) -> DataFrame:
    """Spans of groups that several documents may share: key, span (content id), id, words; or their places: span, id, row, at, count."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, sizes = _split(batch)
            found = spans_of(hash_words(words), sizes, window, gram, common.value)
            take = np.flatnonzero(in_bitmap(found.grams, wanted.value))
            starts, ends, doc = found.starts[take], found.ends[take], found.docs[take]
            texts = [b" ".join(words[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            names = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
            ids = pa.array(batch.column("id").to_numpy()[doc])
            if with_text:
                text = pa.array([None if w else t for w, t in zip(found.whole[take].tolist(), texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(signed(found.keys[take])), names, ids, text], ["key", "span", "id", "words"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [names, ids, batch.column("row").take(pa.array(doc)), pa.array(starts - found.offsets[doc]),
                     pa.array(ends - starts - window + 1)], ["span", "id", "row", "at", "count"])

    layout = "key long, span binary, id long, words binary" if with_text else "span binary, id long, row string, at long, count long"
    return docs.select("id", "row", "text").mapInArrow(apply, layout)


def tree_nodes(words: list[bytes], sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that are ``depth`` words long or more (positions), and the node at that depth each belongs to.

    A node at 2k words is a pair of nodes at k words, so six refinements reach 50.
    """
    node = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    reach = 1
    while reach < depth:
        step = min(reach, depth - reach)
        left, right = node[:len(node) - step], node[step:]
        _, node = np.unique(left * (int(node.max()) + 1) + right, return_inverse=True)
        reach += step
    at = np.arange(len(node))
    inside = at + depth <= ends[:len(node)]
    return at[inside], node[inside]


def first_documents(texts: list[bytes], ids: np.ndarray, depth: int) -> list[tuple[list[int], list[int]]]:
    """For each span: windows at which the first document changes, and that document."""
    split = [t.split(b" ") for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    at, node = tree_nodes([w for words in split for w in words], sizes, depth)
    span = np.repeat(np.arange(len(split)), sizes)[at]
    lowest = np.full(int(node.max()) + 1, _NO_ID)
    np.minimum.at(lowest, node, ids[span])
    first = lowest[node]
    change = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (span[1:] != span[:-1])])
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    cuts = np.searchsorted(span[change], np.arange(len(split) + 1)).tolist()
    windows, firsts = (at - begin[span])[change].tolist(), first[change].tolist()
    return [(windows[a:b], firsts[a:b]) for a, b in zip(cuts, cuts[1:])]


def span_firsts(spans: DataFrame, depth: int, some_whole: bool) -> DataFrame:
    """span, windows, firsts: smallest document of every window of every different span."""
    distinct = spans.groupBy("key", "span", "words").agg(F.min("id").alias("id"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        words = 0

        def tree(rows: list[tuple]) -> pa.RecordBatch:
            found = first_documents([r[2] for r in rows], np.array([r[3] for r in rows]), depth)
            return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), pa.array([w for w, _ in found], pa.list_(pa.int64())),
                                               pa.array([f for _, f in found], pa.list_(pa.int64()))], ["span", "windows", "firsts"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "span", "words", "id"))):
                if held and words >= TREE_WORDS and row[0] != held[-1][0]:
                    yield tree(held)
                    held, words = [], 0
                held.append(row)
                words += row[2].count(b" ") + 1
        if held:
            yield tree(held)

    trees = (distinct.filter("words IS NOT NULL").repartition("key").sortWithinPartitions("key")
             .mapInArrow(grow, "span binary, windows array<long>, firsts array<long>"))
    if not some_whole:
        return trees
    return trees.unionByName(distinct.filter("words IS NULL").select(
        "span", F.array(F.lit(0).cast("long")).alias("windows"), F.array("id").alias("firsts")))


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_spans: int = GROUP_SPANS) -> DataFrame:
    """row, runs: words [from, to) of the row's text that stand in a window which a smaller document has too.

    ``docs`` has id (never NULL), row and text.
    """
    sizes = staged(group_sizes(docs, window, gram).filter("low < high"), "groups")
    context = docs.sparkSession.sparkContext
    wanted = context.broadcast(bitmap(sizes.select("key")))
    hot = sizes.filter(F.col("spans") > group_spans).select("key")
    some_whole = not hot.isEmpty()
    common = context.broadcast(bitmap(hot) if some_whole else None)
    firsts = span_firsts(cut_spans(docs, wanted, common, window, gram, True), window, some_whole)
    places = cut_spans(docs, wanted, common, window, gram, False)
    found = places.join(firsts, "span").filter(F.exists("firsts", lambda first: first < F.col("id")))
    # A stretch of windows with one first document ends where the next begins.
    stretch = F.zip_with(F.arrays_zip("windows", "firsts"), F.concat(F.slice("windows", 2, 1 << 30), F.array("count")), lambda own, end: F.struct(
        (F.col("at") + own["windows"]).alias("from"), (F.col("at") + end - 1 + window).alias("to"), own["firsts"].alias("first")))
    runs = F.transform(F.filter(stretch, lambda s: s["first"] < F.col("id")), lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to")))
    return found.select("row", runs.alias("runs")).groupBy("row").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_spans: int = GROUP_SPANS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans (removed words [from, to)), kept (what is left).

    Removes each word inside a run of ``window`` consecutive words that also starts in a document
    with a smaller doc_id, judged on the input. Words are kept as they are and joined by one space.
    NULL and short texts lose nothing; a NULL doc_id counts as larger than any other. Repeated rows, which share
    their doc_id, do not remove from each other. An empty table gives an empty result; other
    columns are ignored. Words are compared byte by byte; in what is kept, bytes that are not UTF-8
    become U+FFFD. A doc_id that is no integer is refused: texts need an order.
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError(f"doc_id must be an integer, not {docs.schema['doc_id'].dataType.simpleString()}")
    bound_batches(docs.sparkSession)
    ready = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"))
    ready = ready.withColumn("row", F.concat_ws("-", "id", F.md5("text")))  # repeated rows may share it
    runs = repeated_runs(ready, window, gram, group_spans).withColumnRenamed("row", "_row")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, removed, spans, kept = [], [], [], []
            for text, own in zip(utf8(batch.column("text")), batch.column("runs").to_pylist()):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for run in own or ():
                    gone[run["from"]] += 1
                    gone[run["to"]] -= 1
                out = np.cumsum(gone[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8))).tolist()
                counts.append(len(words))
                removed.append(int(out.sum()))
                spans.append([{"from": a, "to": b} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(b" ".join(w for w, g in zip(words, out.tolist()) if not g).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return (ready.join(runs, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "runs")
            .mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<from:bigint,to:bigint>>, kept string"))
