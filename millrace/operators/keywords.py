"""A stored inverted index, and keyword search that reads only the asked terms.

Documents are cut into slabs of bounded size where they are read; only their postings move, packed by
slab and folder. A row of the index is a block: the postings of one
term in one slab, with the highest gains that they can add to a score. Blocks lie in folders by a hash of the
term, sorted by term, beside a dictionary of the terms; a search reads the folders of its terms,
sends blocks to their slab, and adds up scores there. The dictionary knows, for every term, a gain
that k documents reach, so a search starts with a score its k-th hit cannot fall below; a slab is
not scored for a question whose blocks together cannot reach it, or the k-th score found so far.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import strings, word_lists
from millrace.functions.vectors import BestRows
from millrace.operators.keyed import last_n_per_key
from millrace.operators.retrieval import QUESTION_BOUND, SCORE_DIGITS
from millrace.session import bound_batches, fresh_dir, ship_package, unsorted_folders

#: Documents and lexemes of a slab at most (a longer document is a slab by itself); lexemes of a folder of terms, and of one file in it.
SLAB, SLAB_LEXEMES, FOLDER_POSTINGS, FILE_POSTINGS = 2048, 2_000_000, 20_000_000, 2_000_000
#: Blocks of one Arrow batch.
BATCH_BLOCKS = 20_000
#: Pairs of a question and a posting that are added up in one step.
PAIRS = 4_000_000
#: For these k the index keeps a gain that k documents reach; a larger k starts without a bound.
LEVELS = (1, 5, 10, 20, 50, 100)
_SAFE = 1e-6
_BLOCK = "term string, slab long, docs array<long>, tfs array<int>, sizes array<int>, tops array<double>, top_tf int"
_BLOCK_NAMES = ["term", "slab", "docs", "tfs", "sizes", "tops", "top_tf", "bucket"]


def term_bucket(term: str, buckets: int) -> int:
    """Folder of a term: its CRC-32 decides."""
    return zlib.crc32(term.encode()) % buckets


def _bucket(term: Column, buckets: int) -> Column:
    return F.crc32(term.cast("binary")) % F.lit(buckets)


def bm25_gain(tf: np.ndarray, size: np.ndarray, mean: float, k1: float, b: float) -> np.ndarray:
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * size / mean))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of several runs, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def packed_slab(slab: int, ids: np.ndarray, tokens: pa.Array, buckets: int) -> pa.RecordBatch:
    """A slab's postings by folder, one compressed row for each, and in folder -1 the ids of its documents."""
    order = np.argsort(ids, kind="stable")
    lengths = np.nan_to_num(tokens.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ids, sizes = ids[order], lengths[order]
    coded = tokens.flatten().dictionary_encode()
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    cells, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + np.repeat(place, lengths), return_counts=True)
    term, doc = cells // max(1, len(ids)), cells % max(1, len(ids))
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][:len(term)])
    counts = np.diff(np.r_[starts, len(term)])
    words = coded.dictionary.take(pa.array(term[starts]))
    folder = np.fromiter((term_bucket(t, buckets) for t in strings(words)), np.int64, len(words))
    by_folder = np.argsort(folder, kind="stable")
    found, first = np.unique(folder[by_folder], return_index=True)
    out = [(-1, _pack(ids=ids))]
    for name, own in zip(found.tolist(), np.split(by_folder, first[1:])):
        at = _spans(starts[own], counts[own])
        used = np.bincount(doc[at], minlength=len(ids)) > 0  # else ids and sizes would grow with slabs times folders
        out.append((name, _pack(terms=words.take(pa.array(own)), counts=counts[own], places=(np.cumsum(used) - 1)[doc[at]], tfs=tf[at],
                                ids=ids[used], sizes=sizes[used])))
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int32()), pa.array(np.full(len(out), slab)), pa.array([p for _, p in out], pa.binary())],
                                      ["bucket", "slab", "packed"])


def _pack(**arrays: np.ndarray | pa.Array) -> bytes:
    """Arrays of any length as one compressed Arrow row; numbers but ids take 32 bits."""
    columns = [v if isinstance(v, pa.Array) else pa.array(v if k == "ids" else v.astype(np.int32)) for k, v in arrays.items()]
    rows = [pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), v) for v in columns]
    batch, sink = pa.RecordBatch.from_arrays(rows, list(arrays)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(packed).read_next_batch()
    return {name: batch.column(name).flatten() for name in batch.schema.names}


def folder_blocks(bucket: int, slabs: Sequence[int], packed: Sequence[bytes], mean: float, k1: float, b: float) -> pa.RecordBatch:
    """The blocks of a folder from its packed slabs, by term and slab; folder -1 lists each slab's documents."""
    lists = [_unpack(p) for p in packed]
    if bucket < 0:
        counts, n = [len(x["ids"]) for x in lists], len(lists)
        docs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.concat_arrays([x["ids"] for x in lists]))
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.string()), pa.array(slabs, pa.int64()), docs, *(pa.nulls(n, pa.list_(pa.int32())) for _ in range(2)),
             pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.int32()), pa.array([bucket] * n, pa.int32())], _BLOCK_NAMES)
    terms = pa.concat_arrays([x["terms"] for x in lists])
    slab = np.repeat(np.array(slabs, np.int64), [len(x["terms"]) for x in lists])
    order = pc.sort_indices(pa.table({"term": terms, "slab": slab}), [("term", "ascending"), ("slab", "ascending")]).to_numpy().astype(np.int64)
    counts = np.concatenate([x["counts"].to_numpy() for x in lists]).astype(np.int64)
    at = _spans((np.cumsum(counts) - counts)[order], counts[order])
    counts = counts[order]
    docs, size = (np.concatenate([x[c].to_numpy()[x["places"].to_numpy()] for x in lists])[at] for c in ("ids", "sizes"))
    tf = np.concatenate([x["tfs"].to_numpy() for x in lists])[at]
    del lists, at
    starts = np.cumsum(counts) - counts
    gain = bm25_gain(tf, size, mean, k1, b)
    best = gain[np.lexsort((-gain, np.repeat(np.arange(len(counts)), counts)))]
    reached = np.searchsorted(LEVELS, counts, "right")  # a level that a block is too short for has no gain in it
    level = _spans(np.zeros(len(reached), np.int64), reached)
    tops = best[np.repeat(starts, reached) + np.array(LEVELS)[level] - 1]
    offsets = pa.array(np.r_[starts, len(docs)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [terms.take(pa.array(order)), pa.array(slab[order]), *(pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (docs, tf, size)),
         pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(reached)].astype(np.int32)), pa.array(tops)),
         pa.array(np.maximum.reduceat(tf, starts)), pa.array(np.full(len(counts), bucket, np.int32))], _BLOCK_NAMES)


@dataclass
class Blocks:
    """Blocks of one slab: term codes, highest gains and frequencies, and their postings one after the other."""

    codes: np.ndarray
    tops: np.ndarray
    top_tfs: np.ndarray
    counts: np.ndarray
    docs: np.ndarray
    tfs: np.ndarray
    sizes: np.ndarray


@dataclass
class Asked:
    """Questions by term: those asking for term ``t`` are ``asker[first[t]:first[t + 1]]``, with weights."""

    ids: np.ndarray
    n_terms: np.ndarray
    first: np.ndarray
    asker: np.ndarray
    weight: np.ndarray
    floors: np.ndarray


class SlabScorer:
    """Scores slabs for a set of questions; keeps each question's best ``k``, or gives all matches if ``k`` is None."""

    def __init__(self, asked: Asked, k: int | None, mode: str, scoring: str, mean: float, k1: float, b: float) -> None:
        self.asked, self.k, self.every, self.bm25, self.shape = asked, k, mode == "all", scoring == "bm25", (mean, k1, b)
        self.best = BestRows(len(asked.ids), k) if k is not None else None
        self.scored = self.skipped = 0

    def slab(self, blocks: Blocks, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Adds a slab's hits to the best ones, or returns them (question, document, score) if all are wanted."""
        a, n = self.asked, len(self.asked.ids)
        fans = a.first[blocks.codes + 1] - a.first[blocks.codes]
        entry = _spans(a.first[blocks.codes], fans)  # every (block, question that asks for its term)
        block = np.repeat(np.arange(len(fans)), fans)
        top = blocks.tops if self.bm25 else 1.0 + np.log(blocks.top_tfs)
        asker, weight = a.asker[entry], a.weight[entry]
        held = np.bincount(asker, minlength=n)
        able = held == a.n_terms if self.every else held > 0
        if self.best is not None:
            most = np.bincount(asker, weight * top[block], n)
            now = np.array([-s[-1] if len(s) == self.k else 0.0 for s in self.best.scores])
            able &= most * (1 + _SAFE) + _SAFE >= np.maximum(now, a.floors)
        active = np.flatnonzero(able)
        self.scored, self.skipped = self.scored + len(active), self.skipped + int((held > 0).sum()) - len(active)
        if not len(active):
            return None
        live = able[asker]
        block, asker, weight = block[live], asker[live], weight[live]
        row = np.full(n, -1)
        row[active] = np.arange(len(active))
        docs, place = np.unique(blocks.docs, return_inverse=True)
        gain = bm25_gain(blocks.tfs, blocks.sizes, *self.shape) if self.bm25 else 1.0 + np.log(blocks.tfs)
        starts = np.cumsum(blocks.counts) - blocks.counts
        score, hits = np.zeros(len(active) * len(docs)), np.zeros(len(active) * len(docs), np.int64)
        counts = blocks.counts[block]
        for part in np.split(np.arange(len(block)), np.searchsorted(np.cumsum(counts), np.arange(PAIRS, int(counts.sum()), PAIRS))):
            posting = _spans(starts[block[part]], counts[part])
            cell = np.repeat(row[asker[part]], counts[part]) * len(docs) + place[posting]
            score += np.bincount(cell, np.repeat(weight[part], counts[part]) * gain[posting], len(score))
            hits += np.bincount(cell, minlength=len(hits))
        score, hits = np.round(score, SCORE_DIGITS).reshape(len(active), -1), hits.reshape(len(active), -1)
        found = hits == a.n_terms[active][:, None] if self.every else hits > 0
        if allowed is not None:
            found &= np.isin(docs, allowed)
        if self.best is None:
            q, d = np.nonzero(found)
            return a.ids[active[q]], docs[d], score[q, d]
        for i, q in enumerate(active.tolist()):
            self.best.offer(q, -score[i][found[i]], docs[found[i]])
        return None


@dataclass(frozen=True)
class KeywordIndex:
    """An index below ``root``: blocks, dictionary, and the numbers both were built with."""

    spark: SparkSession
    root: str
    documents: int
    slabs: int
    buckets: int
    mean_length: float
    k1: float
    b: float

    @classmethod
    def build(cls, docs: DataFrame, root: str, doc_id: str = "doc_id", tokens: str = "tokens", k1: float = 1.2, b: float = 0.75,
              slab: int = SLAB) -> KeywordIndex:
        """Write the index of ``docs``: unique non-NULL long ids, and lexemes (NULL counts as none),
        as lists or as strings in which they are joined by one space."""
        spark = docs.sparkSession
        ship_package(spark)
        bound_batches(spark)
        rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(tokens).alias("tokens"))
        joined = rows.schema["tokens"].dataType.typeName() == "string"
        gaps = F.octet_length("tokens") - F.octet_length(F.replace("tokens", F.lit(" "), F.lit("")))
        size = F.when(F.col("tokens") != "", gaps + 1) if joined else F.size("tokens")
        n, total, twice = (rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(size, F.lit(0))).alias("size"))
                           .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)), F.min(F.when(F.col("n") > 1, F.col("doc")))).first())
        if twice is not None:
            raise ValueError(f"document {twice} is there twice; an index needs unique ids")
        buckets = max(16, min(4096, -(-total // FOLDER_POSTINGS)))
        mean = total / n if total else 1.0
        files = max(1, -(-total // (buckets * FILE_POSTINGS)))

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            rows = lexemes = 0

            def made() -> pa.RecordBatch:
                table = pa.Table.from_batches(held).combine_chunks()
                ids = table.column("doc").to_numpy()
                name = int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)
                return packed_slab(name, ids, table.column("tokens").combine_chunks(), buckets)

            for batch in batches:
                batch = pa.RecordBatch.from_arrays([batch.column("doc"), word_lists(batch.column("tokens"))], ["doc", "tokens"])
                sizes = np.nan_to_num(batch.column("tokens").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64).tolist()
                start = 0
                for i, size in enumerate(sizes):
                    if rows and (rows == slab or lexemes + size > SLAB_LEXEMES):
                        held.append(batch.slice(start, i - start))
                        yield made()
                        held, rows, lexemes, start = [], 0, 0, i
                    rows, lexemes = rows + 1, lexemes + size
                held.append(batch.slice(start))
            if rows:
                yield made()

        def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def blocks(bucket: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
                made = folder_blocks(bucket, [s for s, _ in held], [p for _, p in held], mean, k1, b)
                for at in range(0, made.num_rows, BATCH_BLOCKS):
                    yield made.slice(at, BATCH_BLOCKS)

            at, held = None, []
            for batch in batches:
                for bucket, file, number, packed in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and at != (bucket, file):
                        yield from blocks(at[0], held)
                        held = []
                    at = bucket, file
                    held.append((number, packed))
            if held:
                yield from blocks(at[0], held)

        # Each task merges and writes one file of one folder: equal shares, and blocks go out as they come, not sorted again by folder.
        merged = (rows.mapInArrow(cut, "bucket int, slab long, packed binary").select("bucket", F.pmod("slab", F.lit(files)).cast("int").alias("file"), "slab", "packed")
                  .repartitionById((buckets + 1) * files, (F.col("bucket") + 1) * F.lit(files) + F.col("file"))
                  .sortWithinPartitions("bucket", "file", "slab").mapInArrow(merge, f"{_BLOCK}, bucket int"))
        with unsorted_folders(spark):
            merged.write.partitionBy("bucket").parquet(f"{root}/blocks")
        stored = spark.read.schema(f"{_BLOCK}, bucket int").parquet(f"{root}/blocks")
        slabs = max(1, stored.filter("bucket < 0").count())
        tops = F.array(*[F.coalesce(F.max(F.get("tops", F.lit(i))), F.lit(0.0)) for i in range(len(LEVELS))])
        (stored.filter("bucket >= 0").groupBy("bucket", "term").agg(F.sum(F.size("docs")).alias("df"), tops.alias("tops"))
         .repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{root}/terms"))
        numbers = (n, slabs, buckets, float(mean), float(k1), float(b))
        spark.createDataFrame([numbers], "documents long, slabs long, buckets long, mean_length double, k1 double, b double").coalesce(1).write.parquet(f"{root}/numbers")
        return cls(spark, root, *numbers)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> KeywordIndex:
        ship_package(spark)
        return cls(spark, root, *spark.read.parquet(f"{root}/numbers").first())

    @property
    def blocks(self) -> DataFrame:
        return self._rows.filter("bucket >= 0")

    @property
    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{_BLOCK}, bucket int").parquet(f"{self.root}/blocks")

    @property
    def slab_documents(self) -> DataFrame:
        """doc and its slab, for every document."""
        return self._rows.filter("bucket < 0").select(F.explode("docs").alias("doc"), "slab")

    @property
    def terms(self) -> DataFrame:
        """bucket, term, df, tops of every term."""
        return self.spark.read.schema("term string, df long, tops array<double>, bucket int").parquet(f"{self.root}/terms")

    def postings(self) -> DataFrame:
        """term, doc_id, tf of the whole index."""
        return self.blocks.select("term", F.inline(F.arrays_zip(F.col("docs").alias("doc_id"), F.col("tfs").cast("array<long>").alias("tf"))))

    def of_terms(self, table: DataFrame, terms: Sequence[str]) -> DataFrame:
        """Rows of the listed terms with their places in the list (``code``); other folders are not read."""
        folders = sorted({term_bucket(t, self.buckets) for t in terms})
        listed = self.spark.createDataFrame(pa.table({"term": pa.array(terms, pa.string()), "code": pa.array(range(len(terms)), pa.int64())}),
                                            "term string, code long")
        return table.filter(F.col("bucket").isin(folders)).join(F.broadcast(listed), "term")

    def match(self, questions: DataFrame, question_id: str = "query_id", doc_id: str = "doc_id", mode: str = "all", k: int | None = None,
              allowed: DataFrame | None = None, rank_as: str = "rank", bound: int = QUESTION_BOUND) -> DataFrame:
        """Documents with all (or any) of a question's lexemes, and their frequency score; see :meth:`bm25`."""
        if mode not in ("all", "any"):
            raise ValueError("mode must be 'all' or 'any'")
        return self._search(questions, question_id, doc_id, mode, "frequency", k, allowed, rank_as, bound)

    def bm25(self, questions: DataFrame, k: int, question_id: str = "query_id", doc_id: str = "doc_id", mode: str = "any",
             allowed: DataFrame | None = None, rank_as: str = "rank", bound: int = QUESTION_BOUND) -> DataFrame:
        """Exact BM25 top ``k`` of every question (id and ``terms``), with the index's own k1 and b.

        ``allowed`` holds ids of the documents that may be found; document frequencies are those of the
        whole index. Up to ``bound`` questions are answered at a time, and more in turns, each written
        before the next begins.
        """
        return self._search(questions, question_id, doc_id, mode, "bm25", k, allowed, rank_as, bound)

    def _search(self, questions: DataFrame, question_id: str, doc_id: str, mode: str, scoring: str, k: int | None, allowed: DataFrame | None,
                rank_as: str, bound: int) -> DataFrame:
        names = (question_id, doc_id, "score")

        def best(asked: pa.Table) -> DataFrame:
            found = self._answer(asked, names, mode, scoring, k, allowed)
            return found if k is None else last_n_per_key(found, [question_id], [F.col("score").desc(), F.col(doc_id)], k, rank_as=rank_as)

        asked = questions.select(F.col(question_id).cast("long").alias(question_id), "terms").filter(F.size("terms") > 0)
        head = asked.limit(bound + 1).toArrow()
        if head.num_rows <= bound:
            return best(head)
        turns = -(-asked.count() // bound)
        parts = []
        for i in range(turns):
            path = fresh_dir(self.spark, "answers")
            found = best(asked.filter(F.pmod(F.xxhash64(question_id), F.lit(turns)) == i).toArrow())
            found.write.parquet(path)
            parts.append(self.spark.read.schema(found.schema).parquet(path))
        return reduce(DataFrame.unionByName, parts)

    def _answer(self, asked: pa.Table, names: tuple[str, str, str], mode: str, scoring: str, k: int | None, allowed: DataFrame | None) -> DataFrame:
        layout = f"{names[0]} long, {names[1]} long, score double"
        ids, lists = asked.column(0).to_numpy(), asked.column(1).combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        coded = lists.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        if not vocabulary:
            return self.spark.createDataFrame([], layout)
        known = self.of_terms(self.terms, vocabulary).select("code", "df", "tops").toArrow()  # one row per asked term at most
        weight, reached = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
        code, df = known.column("code").to_numpy(), known.column("df").to_numpy()
        weight[code] = np.log(1.0 + (self.documents - df + 0.5) / (df + 0.5)) if scoring == "bm25" else 1.0
        level = next((i for i, at in enumerate(LEVELS) if k is not None and k <= at), None)
        if level is not None and scoring == "bm25":
            reached[code] = [tops[level] for tops in known.column("tops").to_pylist()]
        term, owner = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(ids)), sizes)
        floors = np.zeros(len(ids))
        if mode == "any" and allowed is None:  # k documents reach this with one of the terms alone
            np.maximum.at(floors, owner, weight[term] * reached[term])
        order = np.argsort(term, kind="stable")
        asking = Asked(ids, sizes, np.searchsorted(term[order], np.arange(len(vocabulary) + 1)), owner[order], weight[term[order]], floors * (1 - _SAFE))
        shared = self.spark.sparkContext.broadcast((asking, k, mode, scoring, self.mean_length, self.k1, self.b))
        filtered = allowed is not None
        rows = self.of_terms(self.blocks, vocabulary).select(
            "slab", "code", "docs", "tfs", "sizes", F.col("tops")[0].alias("top"), "top_tf")
        if filtered:
            may = allowed.select(F.col(names[1]).cast("long").alias("doc")).filter("doc IS NOT NULL")
            empty = F.array().cast("array<int>")
            rows = rows.unionByName(may.join(self.slab_documents, "doc").select("slab", F.lit(-1).cast("long").alias("code"), F.array("doc").alias("docs"),
                                               empty.alias("tfs"), empty.alias("sizes"), F.lit(0.0).alias("top"), F.lit(0).alias("top_tf")))

        def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer, held = SlabScorer(*shared.value), []

            def finish() -> pa.RecordBatch | None:
                table = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                code = table.column("code").to_numpy()
                lists = {c: table.column(c).combine_chunks() for c in ("docs", "tfs", "sizes")}
                may = np.unique(lists["docs"].filter(pa.array(code < 0)).flatten().to_numpy()) if filtered else None
                terms = pa.array(code >= 0)
                if not (code >= 0).any():
                    return None
                docs, tfs, lengths = (v.filter(terms).flatten().to_numpy() for v in lists.values())
                counts = lists["docs"].filter(terms).value_lengths().to_numpy().astype(np.int64)
                top, top_tf = (table.column(c).to_numpy()[code >= 0] for c in ("top", "top_tf"))
                hits = scorer.slab(Blocks(code[code >= 0], top, top_tf, counts, docs, tfs, lengths), may)
                return None if hits is None else pa.RecordBatch.from_arrays([pa.array(h) for h in hits], names=list(names))

            for batch in batches:
                slab = batch.column("slab").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(slab)) + 1).tolist(), len(slab)]
                for start, end in zip(edges, edges[1:]):
                    if held and end > start and held[-1].column("slab")[0].as_py() != slab[start] and (out := finish()):
                        yield out
                    if end > start:
                        held.append(batch.slice(start, end - start))
            if held and (out := finish()):
                yield out
            if scorer.best is not None:
                made = scorer.best.batch(scorer.asked.ids, names)
                yield pa.RecordBatch.from_arrays([made.column(0), made.column(1), pa.array(-made.column(2).to_numpy())], names=list(names))

        parts = min(self.slabs, int(self.spark.conf.get("spark.sql.shuffle.partitions")))  # small blocks are worth many tasks
        return rows.repartition(parts, "slab").sortWithinPartitions("slab").mapInArrow(score, layout)
