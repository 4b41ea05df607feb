"""Vector search, keyword search and rank fusion for a whole table of questions at once.

Scans follow one pattern: the questions travel to the corpus, each task keeps its best k rows
per question, and only those candidates are shuffled. No question x document pair is emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from millrace.functions.skew import (BROADCAST_LIMIT, key_set, lookup_join, planned_bytes, settle)
from millrace.functions.text import chunks, hashed_features, lexemes
from millrace.functions.vectors import BestRows, as_matrix, pairwise
from millrace.operators.keyed import last_n_per_key
from millrace.session import bound_batches, ship_package

#: Most questions sent to every task in one piece.
QUESTION_BOUND = 4096
#: Pairs of a question and a document's lexeme that are looked at in one step.
PAIR_BOUND = 4_000_000
#: Most distinct question lexemes sent to every task.
TERM_BOUND = 200_000
#: Decimals at which two scores count as equal (equal scores are ordered by id).
SCORE_DIGITS = 9

Scan = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def scan_against(corpus: DataFrame, questions: DataFrame, question_id: str,
                 prepare: Callable[[pa.Table], Scan], schema: str, bound: int = QUESTION_BOUND) -> DataFrame:
    """Run ``prepare(questions)`` over every part of the corpus.

    Up to ``bound`` questions are broadcast and the corpus is read once, in place. A larger table is
    cut into blocks of about that many, and the corpus, never shuffled or repeated, is read once per block; the
    candidates are the same.
    """
    spark = corpus.sparkSession
    ship_package(spark)

    def against(block: pa.Table) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from prepare(shared.value)(batches)

        return corpus.mapInArrow(scan, schema)

    head = questions.limit(bound + 1).toArrow()
    if head.num_rows <= bound:
        return against(head)
    blocks = -(-questions.count() // bound)
    place = F.pmod(F.xxhash64(question_id), F.lit(blocks))
    return reduce(DataFrame.unionByName, [against(questions.filter(place == i).toArrow()) for i in range(blocks)])


# --- vectors --------------------------------------------------------------------------------

def embed(df: DataFrame, id_col: str, text: str,
          model: Callable[[list[str]], Sequence[Sequence[float]]], dims: int,
          batch: int = 16) -> DataFrame:
    """Embed a text column with an injected model, ``batch`` texts per call.

    The number and the length of the returned vectors are checked.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches:
            for start in range(0, piece.num_rows, batch):
                part = piece.slice(start, batch)
                vectors = model([t or "" for t in part.column(1).to_pylist()])
                if len(vectors) != part.num_rows:
                    raise ValueError(f"model gave {len(vectors)} vectors for {part.num_rows} texts")
                if any(len(v) != dims for v in vectors):
                    raise ValueError(f"model gave a vector that does not have {dims} values")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([list(v) for v in vectors], pa.list_(pa.float32()))],
                    names=[id_col, "embedding"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, embedding array<float>")


def embed_hashed(df: DataFrame, id_col: str, tokens: Column, dims: int = 64,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Model-free embedding: signed counts of hashed lexemes, computed where the rows are.

    Returns the id, the ``keep`` columns unchanged, and ``embedding``.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    picked = df.select(id_col, *keep, tokens.alias("_tokens"))
    names = [id_col, *keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches:
            matrix = hashed_features(piece.column(len(names)), dims)
            offsets = np.arange(0, matrix.size + 1, dims, dtype=np.int32)
            vectors = pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([*piece.columns[:len(names)], vectors], names=[*names, "embedding"])

    schema = StructType([picked.schema[n] for n in names]).add("embedding", ArrayType(FloatType()))
    return picked.mapInArrow(run, schema)


def knowledge_rows(docs: DataFrame, doc_id: str, source: str, text: str, lang: str | Column = "en",
                   max_chars: int = 1800, overlap: int = 200, dims: int = 64) -> DataFrame:
    """Rows of a searchable chunk table, row by row from the documents and without a shuffle.

    ``chunk_id`` is the document id times 2^20 plus the chunk's place, so a reload gives the
    same ids; ids too large for that are hashed with the place. Lexemes and vector are stored: searches read one narrow column each and analyse
    no text again.
    """
    cut = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"),
                      (lang if isinstance(lang, Column) else F.lit(lang)).alias("lang"),
                      F.posexplode(chunks(text, max_chars, overlap)).alias("chunk_index", "chunk"))
    fits = F.col("doc_id").between(-(1 << 42), (1 << 42) - 1)
    chunk_id = F.when(fits, F.shiftleft("doc_id", 20) + F.col("chunk_index")).otherwise(F.xxhash64("doc_id", "chunk_index"))
    rows = cut.select(chunk_id.alias("chunk_id"), "source", "chunk",
                      F.to_json(F.struct("chunk_index", F.length("chunk").alias("n_chars"))).alias("metadata"),
                      lexemes("chunk", F.col("lang")).alias("tokens"))
    return embed_hashed(rows, "chunk_id", F.col("tokens"), dims, ["source", "chunk", "metadata", "tokens"])


def mean_vectors(df: DataFrame, group: str, vec: str = "embedding") -> DataFrame:
    """Mean vector per group. Each task sums its rows as arrays and sends one row per group."""
    ship_package(df.sparkSession)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        rows: dict[int, int] = {}
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            if not batch.num_rows:
                continue
            matrix = as_matrix(batch.column(1), len(batch.column(1)[0]))
            names, place = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            part = np.zeros((len(names), matrix.shape[1]))
            np.add.at(part, place, matrix)
            for name, total, n in zip(names.tolist(), part, np.bincount(place)):
                sums[name] = sums[name] + total if name in sums else total
                rows[name] = rows.get(name, 0) + int(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([rows[g] for g in sums], pa.int64()),
             pa.array([list(v) for v in sums.values()], pa.list_(pa.float64()))], names=[group, "n", "total"])

    parts = (df.dropna(subset=[group]).select(F.col(group).cast("long").alias(group), vec)
             .mapInArrow(add, f"{group} long, n long, total array<double>"))
    cells = (parts.select(group, "n", F.posexplode("total").alias("pos", "x")).groupBy(group, "pos")
             .agg((F.sum("x") / F.sum("n")).alias("mean")))
    # As many values per group as a vector has.
    return (cells.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("v"))
            .select(group, F.col("v.mean").cast("array<float>").alias(vec)))


def _ranked(candidates: DataFrame, question_id: str, doc_id: str, score: str, k: int,
            rank: str, descending: bool) -> DataFrame:
    order = [F.col(score).desc() if descending else F.col(score).asc(), F.col(doc_id)]
    return last_n_per_key(candidates, [question_id], order, k, rank_as=rank)


def _vector_scan(k: int, metric: str, digits: int, names: tuple[str, str, str]):
    def prepare(questions: pa.Table) -> Scan:
        table = questions.combine_chunks()
        ids = table.column(0).to_numpy()
        vectors = table.column(1).combine_chunks()
        dims = len(vectors[0]) if len(vectors) else 0
        wanted = as_matrix(vectors, dims)
        probes = table.column(2).to_pylist() if table.num_columns > 2 else None
        by_cell: dict[int, list[int]] = {}
        for j, cells in enumerate(probes or []):
            for cell in cells:
                by_cell.setdefault(cell, []).append(j)

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = BestRows(len(ids), k)
            for batch in batches:
                present = batch.column(1).is_valid()
                batch = batch.filter(present)
                if not batch.num_rows or not len(ids):
                    continue
                row_ids = batch.column(0).to_numpy()
                matrix = as_matrix(batch.column(1), dims)
                if probes is None:
                    groups = [(np.arange(len(row_ids)), range(len(ids)))]
                else:
                    cells = batch.column(2).to_numpy()
                    groups = [(np.flatnonzero(cells == cell), by_cell.get(int(cell), []))
                              for cell in np.unique(cells)]
                for rows, queries in groups:
                    queries = list(queries)
                    if not queries:
                        continue
                    # At most ~4M distances at a time.
                    step = max(1, 4_000_000 // len(queries))
                    for start in range(0, len(rows), step):
                        part = rows[start:start + step]
                        gaps = np.round(pairwise(matrix[part], wanted[queries], metric), digits)
                        for column, query in enumerate(queries):
                            best.offer(query, gaps[:, column], row_ids[part])
            yield best.batch(ids, names)

        return scan

    return prepare


def knn_exact(questions: DataFrame, corpus: DataFrame, k: int, question_id: str = "query_id",
              question_vec: str = "embedding", doc_id: str = "doc_id", vec: str = "embedding",
              metric: str = "cosine", where: Column | None = None, rank_as: str = "rank",
              bound: int = QUESTION_BOUND) -> DataFrame:
    """Exact ``k`` nearest corpus rows of every question. ``where`` filters *before* ranking.

    Ids are longs. A question without a vector has no answer, a row without one is no neighbour.
    Returns question id, document id, ``distance`` and the rank.
    """
    pool = corpus if where is None else corpus.filter(where)
    rows = pool.select(F.col(doc_id).cast("long").alias(doc_id), vec)
    asked = (questions.filter(F.col(question_vec).isNotNull())
             .select(F.col(question_id).cast("long").alias(question_id), question_vec))
    names = (question_id, doc_id, "distance")
    found = scan_against(rows, asked, question_id,
                         _vector_scan(k, metric, SCORE_DIGITS, names),
                         f"{question_id} long, {doc_id} long, distance double", bound)
    return _ranked(found, question_id, doc_id, "distance", k, rank_as, descending=False)


@dataclass
class IvfIndex:
    """Corpus rows with their cell, the cell centres, and the metric both were built for."""

    table: DataFrame
    centres: np.ndarray
    metric: str

    def save(self, root: str, doc_id: str = "doc_id", rows_per_file: int = 500_000) -> IvfIndex:
        """Write the index partitioned by cell and return the stored one.

        A large cell becomes several files written by several tasks; a small one a single file.
        """
        sizes = settle(self.table.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")))
        files = sizes.select("cell", F.ceil(F.col("_n") / F.lit(rows_per_file)).alias("_files"))
        placed = lookup_join(self.table, files, ["cell"]).withColumn(
            "_file", F.pmod(F.xxhash64(doc_id), F.col("_files")))
        (placed.repartition("cell", "_file").drop("_files", "_file")
         .write.partitionBy("cell").parquet(f"{root}/rows"))
        spark = self.table.sparkSession
        centres = [(i, [float(x) for x in c], self.metric) for i, c in enumerate(self.centres)]
        (spark.createDataFrame(centres, "cell int, centre array<double>, metric string").coalesce(1)
         .write.parquet(f"{root}/centres"))
        return IvfIndex.load(spark, root)

    @staticmethod
    def load(spark: SparkSession, root: str) -> IvfIndex:
        """Open a stored index; only the centres are read."""
        centres = spark.read.parquet(f"{root}/centres").orderBy("cell").collect()
        return IvfIndex(spark.read.parquet(f"{root}/rows"), np.array([r.centre for r in centres]),
                        centres[0].metric)


def ivf_build(corpus: DataFrame, cells: int, doc_id: str = "doc_id", vec: str = "embedding",
              metric: str = "cosine", seed: int = 7, share: float = 1.0,
              centres: np.ndarray | None = None) -> IvfIndex:
    """Cluster the corpus into cells with MLlib k-means and tag every row with its cell.

    Centres are learnt from all rows, or from the ``share`` of them that is asked for; given
    ``centres`` are taken as they are. Every row that has a vector is assigned; under cosine a zero
    vector is nobody's neighbour and is left out, under l2 it is a row like any other.
    Save the index before searching it often: a search then reads only the probed cells.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if metric not in ("cosine", "l2"):
        raise ValueError("an index is built for 'cosine' or 'l2'")
    rows = corpus.select(F.col(doc_id).cast("long").alias(doc_id), vec)
    usable = rows.filter(F.col(vec).isNotNull())
    if metric == "cosine":
        usable = usable.filter(F.exists(vec, lambda x: x != 0))
    if centres is None:
        training = (usable if share == 1.0 else usable.sample(share, seed)).select(
            array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
        model = KMeans(k=cells, seed=seed, maxIter=15, distanceMeasure="cosine" if metric == "cosine"
                       else "euclidean").fit(training)
        centres = np.stack([np.asarray(c) for c in model.clusterCenters()])
    shared = corpus.sparkSession.sparkContext.broadcast(centres)

    ship_package(corpus.sparkSession)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps = pairwise(as_matrix(batch.column(1), shared.value.shape[1]), shared.value, metric)
            nearest = np.argmin(np.nan_to_num(gaps, nan=np.inf), axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nearest)],
                                             names=[doc_id, vec, "cell"])

    tagged = usable.mapInArrow(assign, f"{doc_id} long, {vec} array<float>, cell int")
    return IvfIndex(tagged, centres, metric)


def knn_ivf(questions: DataFrame, index: IvfIndex, k: int, nprobe: int,
            question_id: str = "query_id", question_vec: str = "embedding",
            doc_id: str = "doc_id", vec: str = "embedding", metric: str = "cosine",
            rank_as: str = "rank", bound: int = QUESTION_BOUND) -> DataFrame:
    """Approximate nearest rows: each question looks into its ``nprobe`` nearest cells.

    ``nprobe`` is the recall dial; with all cells probed the answer is exact. A metric other
    than the index's raises instead of silently falling back.
    """
    if metric != index.metric:
        raise ValueError(f"the index was built for {index.metric!r}, not {metric!r}")
    ship_package(questions.sparkSession)
    shared = questions.sparkSession.sparkContext.broadcast(index.centres)

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps = pairwise(as_matrix(batch.column(1), shared.value.shape[1]), shared.value, metric)
            cells = np.argsort(gaps, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(cells), pa.list_(pa.int32()))],
                names=[question_id, question_vec, "cells"])

    asked = (questions.filter(F.col(question_vec).isNotNull())
             .select(F.col(question_id).cast("long").alias(question_id), question_vec)
             .mapInArrow(probe, f"{question_id} long, {question_vec} array<float>, cells array<int>"))
    # As many values as there are cells at most.
    wanted = [r[0] for r in asked.select(F.explode("cells")).distinct().collect()]
    rows = index.table.filter(F.col("cell").isin(wanted)).select(doc_id, vec, "cell")
    names = (question_id, doc_id, "distance")
    found = scan_against(rows, asked, question_id,
                         _vector_scan(k, metric, SCORE_DIGITS, names),
                         f"{question_id} long, {doc_id} long, distance double", bound)
    return _ranked(found, question_id, doc_id, "distance", k, rank_as, descending=False)


def probes_for(questions: DataFrame, index: IvfIndex, exact: DataFrame, k: int, recall: float = 0.9,
               question_id: str = "query_id", doc_id: str = "doc_id", **names: str) -> int:
    """Fewest probes, among powers of two and all cells, that find this share of the ``exact`` neighbours."""
    cells = len(index.centres)
    for nprobe in [1 << i for i in range(cells.bit_length()) if 1 << i < cells]:
        found = knn_ivf(questions, index, k, nprobe, question_id=question_id, doc_id=doc_id, metric=index.metric, **names)
        if (recall_against(found, exact, question_id, doc_id).agg(F.avg("recall")).first()[0] or 0.0) >= recall:
            return nprobe
    return cells


# --- keywords -------------------------------------------------------------------------------

def postings(docs: DataFrame, doc_id: str, tokens: str = "tokens") -> DataFrame:
    """Inverted index rows (term, document, tf). Write it bucketed by ``term``."""
    return (docs.select(doc_id, F.explode(tokens).alias("term"))
            .groupBy("term", doc_id).agg(F.count(F.lit(1)).alias("tf")))


def _sizes(tokens: pa.Array) -> np.ndarray:
    return np.nan_to_num(tokens.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def _occurrences(tokens: pa.Array, sizes: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and vocabulary place of every token that is in the vocabulary."""
    place = pc.fill_null(pc.index_in(tokens.flatten(), value_set=vocabulary), -1)
    place = place.to_numpy(zero_copy_only=False).astype(np.int64)
    known = place >= 0
    return np.repeat(np.arange(len(sizes)), sizes)[known], place[known]


def _term_scan(k: int | None, mode: str, scoring: str, k1: float, b: float, mean_length: float,
               digits: int, names: tuple[str, str, str]):
    def prepare(questions: pa.Table) -> Scan:
        ids = questions.column(0).to_numpy()
        terms = questions.column(1).combine_chunks()
        weights = questions.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = terms.flatten().dictionary_encode()
        vocabulary = encoded.dictionary
        code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        asker = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(code, kind="stable")
        asker, weights = asker[order], weights[order]
        per_term = np.bincount(code, minlength=len(vocabulary))
        first = np.concatenate([[0], np.cumsum(per_term)[:-1]]) if len(per_term) else per_term

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = BestRows(len(ids), k) if k is not None else None
            for whole in batches:
                pending = [whole.slice(start, 1000) for start in range(0, whole.num_rows, 1000)]
                while pending:
                    batch = pending.pop()
                    if batch.num_rows > 1 and pairs(batch) > PAIR_BOUND:
                        half = batch.num_rows // 2
                        pending += [batch.slice(0, half), batch.slice(half)]
                        continue
                    q, row, score = match(batch)
                    doc_ids = batch.column(0).to_numpy()[row]
                    if best is None:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[q]), pa.array(doc_ids), pa.array(score)],
                            names=list(names))
                        continue
                    by_query = np.argsort(q, kind="stable")
                    cuts = np.flatnonzero(np.diff(q[by_query])) + 1
                    for part in np.split(by_query, cuts):
                        if len(part):
                            best.offer(int(q[part[0]]), -score[part], doc_ids[part])
            if best is not None:
                out = best.batch(ids, names)
                yield pa.RecordBatch.from_arrays(
                    [out.column(0), out.column(1), pc.negate(out.column(2))], names=list(names))

        def pairs(batch: pa.RecordBatch) -> int:
            """Most (question, lexeme) pairs that the batch can give."""
            _, code = _occurrences(batch.column(1), _sizes(batch.column(1)), vocabulary)
            return int(per_term[code].sum()) if len(code) else 0

        def match(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lengths = _sizes(batch.column(1))
            owner, code = _occurrences(batch.column(1), lengths, vocabulary)
            size = max(len(vocabulary), 1)
            cell, tf = np.unique(owner * size + code, return_counts=True)
            row, term = cell // size, cell % size
            if scoring == "bm25":
                norm = k1 * (1.0 - b + b * lengths[row] / mean_length)
                gain = tf * (k1 + 1.0) / (tf + norm)
            else:
                gain = 1.0 + np.log(tf)
            fan = per_term[term] if len(term) else np.zeros(0, dtype=np.int64)
            ends = np.cumsum(fan)
            total = int(ends[-1]) if len(ends) else 0
            pick = np.repeat(first[term] if len(term) else fan, fan) + (
                np.arange(total) - np.repeat(ends - fan, fan))
            pair = np.repeat(row, fan) * max(len(ids), 1) + asker[pick]
            unique, place, hits = np.unique(pair, return_inverse=True, return_counts=True)
            score = np.round(np.bincount(place, weights=weights[pick] * np.repeat(gain, fan),
                                         minlength=len(unique)), digits)
            q = unique % max(len(ids), 1)
            doc = unique // max(len(ids), 1)
            if mode == "all":
                full = hits == sizes[q]
                return q[full], doc[full], score[full]
            return q, doc, score

        return scan

    return prepare


def question_terms(questions: DataFrame, question_id: str, tokens: Column) -> DataFrame:
    """Distinct lexemes per question, as ``terms``; questions without any match nothing."""
    return (questions.select(F.col(question_id).cast("long").alias(question_id),
                             F.array_sort(F.array_distinct(tokens)).alias("terms"))
            .filter(F.size("terms") > 0))


def keyword_match(questions: DataFrame, docs: DataFrame, question_id: str = "query_id",
                  doc_id: str = "doc_id", tokens: str = "tokens", mode: str = "all",
                  k: int | None = None, rank_as: str = "rank", where: Column | None = None,
                  bound: int = QUESTION_BOUND) -> DataFrame:
    """Documents holding all (or any) of a question's lexemes, with a frequency score.

    The score sums ``1 + ln(tf)`` over matched lexemes: frequency only, no rarity weight. With
    ``k`` the best k per question are ranked, without it every match is returned.
    ``questions`` comes from :func:`question_terms`.
    """
    if mode not in ("all", "any"):
        raise ValueError("mode must be 'all' or 'any'")
    pool = docs if where is None else docs.filter(where)
    asked = questions.select(question_id, "terms",
                             F.transform("terms", lambda t: F.lit(1.0)).alias("weights"))
    names = (question_id, doc_id, "score")
    found = scan_against(pool.select(F.col(doc_id).cast("long").alias(doc_id), tokens),
                         asked, question_id,
                         _term_scan(k, mode, "frequency", 0.0, 0.0, 1.0, SCORE_DIGITS, names),
                         f"{question_id} long, {doc_id} long, score double", bound)
    if k is None:
        return found
    return _ranked(found, question_id, doc_id, "score", k, rank_as, descending=True)


def corpus_statistics(docs: DataFrame, terms: DataFrame, tokens: str = "tokens",
                      bound: int = TERM_BOUND) -> tuple[int, float, DataFrame]:
    """Number of documents, their mean length, and (term, df) for the listed terms.

    Up to ``bound`` terms are broadcast and one scan gives all three, combined before the
    shuffle. More terms are matched by a join on the exploded documents.
    """
    ship_package(docs.sparkSession)
    listed = terms.limit(bound + 1).toArrow().column(0).combine_chunks()
    if len(listed) <= bound:
        shared = docs.sparkSession.sparkContext.broadcast(listed)

        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = shared.value
            size = max(len(vocabulary), 1)
            seen = np.zeros(size, dtype=np.int64)
            rows = length = 0
            for batch in batches:
                sizes = _sizes(batch.column(0))
                owner, code = _occurrences(batch.column(0), sizes, vocabulary)
                seen += np.bincount(np.unique(owner * size + code) % size, minlength=size)
                rows, length = rows + len(sizes), length + int(sizes.sum())
            hit = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([[-1, -2], hit]), pa.int64()),
                 pa.array(np.concatenate([[rows, length], seen[hit]]), pa.int64())], names=["code", "n"])

        totals = docs.select(tokens).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n"))
        found = dict(tuple(r) for r in totals.collect())  # at most bound + 2 rows
        total, length = found.pop(-1, 0), found.pop(-2, 0)
        words = listed.to_pylist()
        frequency = docs.sparkSession.createDataFrame(
            pa.table({"term": pa.array([words[c] for c in found], pa.string()),
                      "df": pa.array(list(found.values()), pa.int64())}), "term string, df long")
        return total, length / total if total else 0.0, frequency

    size = docs.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(F.size(tokens), F.lit(0))).alias("mean")).first()
    seen = docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
    frequency = (lookup_join(seen, settle(terms), ["term"], "left_semi")
                 .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return size["n"], float(size["mean"] or 0.0), frequency


def bm25(questions: DataFrame, docs: DataFrame, k: int, question_id: str = "query_id",
         doc_id: str = "doc_id", tokens: str = "tokens", k1: float = 1.2, b: float = 0.75,
         mode: str = "any", rank_as: str = "rank", bound: int = QUESTION_BOUND, term_bound: int = TERM_BOUND) -> DataFrame:
    """Exact BM25 top ``k`` per question: one scan for the corpus statistics, one to score."""
    vocabulary = questions.select(F.explode("terms").alias("term")).distinct()
    total, mean, frequency = corpus_statistics(docs, vocabulary, tokens, term_bound)
    idf = F.log(F.lit(1.0) + (F.lit(float(total)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = (questions.select(question_id, F.explode("terms").alias("term"))
                .join(frequency, "term", "left")
                .groupBy(question_id)
                .agg(F.sort_array(F.collect_list(
                    F.struct("term", F.coalesce(idf, F.lit(0.0)).alias("w")))).alias("pairs"))
                .select(question_id, F.col("pairs.term").alias("terms"),
                        F.col("pairs.w").alias("weights")))
    names = (question_id, doc_id, "score")
    found = scan_against(docs.select(F.col(doc_id).cast("long").alias(doc_id), tokens),
                         weighted, question_id,
                         _term_scan(k, mode, "bm25", k1, b, mean or 1.0, SCORE_DIGITS, names),
                         f"{question_id} long, {doc_id} long, score double", bound)
    return _ranked(found, question_id, doc_id, "score", k, rank_as, descending=True)


# --- fusion and what follows ----------------------------------------------------------------

def rrf_join(vector_hits: DataFrame, keyword_hits: DataFrame, k: int, c: int = 60,
             question_id: str = "query_id", doc_id: str = "doc_id") -> DataFrame:
    """Reciprocal rank fusion of two ranked lists, keeping both ranks; a missing rank adds 0."""
    def part(rank: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(float(c)) + F.col(rank)), F.lit(0.0))

    left = vector_hits.select(question_id, doc_id, F.col("rank").alias("vec_rank"))
    right = keyword_hits.select(question_id, doc_id, F.col("rank").alias("key_rank"))
    fused = (left.join(right, [question_id, doc_id], "full")
             .withColumn("rrf", part("vec_rank") + part("key_rank")))
    return _ranked(fused, question_id, doc_id, "rrf", k, "rank", descending=True)


def rrf_union(legs: Sequence[DataFrame], k: int, c: int = 60, question_id: str = "query_id",
              doc_id: str = "doc_id") -> DataFrame:
    """Reciprocal rank fusion of any number of ranked lists by summing 1/(c + rank)."""
    stacked = reduce(DataFrame.unionByName,
                     [leg.select(question_id, doc_id, "rank") for leg in legs])
    fused = stacked.groupBy(question_id, doc_id).agg(
        F.sum(F.lit(1.0) / (F.lit(float(c)) + F.col("rank"))).alias("rrf"))
    return _ranked(fused, question_id, doc_id, "rrf", k, "rank", descending=True)


def leg_size(k: int) -> int:
    """Length of each ranked list for the union form: twice k, at least 20."""
    return max(2 * k, 20)


def attach_documents(hits: DataFrame, docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add document columns to ranked hits; the short hit list travels, not the documents."""
    short = settle(hits)
    if planned_bytes(short) <= BROADCAST_LIMIT:
        return docs.join(F.broadcast(short), doc_id)
    return lookup_join(short, docs, [doc_id])


def snippets(hits: DataFrame, docs: DataFrame, content: str, length: int = 240,
             question_id: str = "query_id", doc_id: str = "doc_id") -> DataFrame:
    """Ranked hits with the beginning of each document, as shown to a caller."""
    shown = docs.select(doc_id, F.substring(content, 1, length).alias("snippet"))
    return attach_documents(hits.select(question_id, doc_id, "rank"), shown, doc_id)


def context_blocks(hits: DataFrame, docs: DataFrame, source: str, title: Column, content: str,
                   question_id: str = "query_id", doc_id: str = "doc_id") -> DataFrame:
    """One cited context text per question from its ranked hits, and the cited sources in order."""
    passages = attach_documents(
        hits.select(question_id, doc_id, "rank"),
        docs.select(doc_id, F.col(source).alias("_source"), title.alias("_title"),
                    F.col(content).alias("_content")), doc_id)
    passage = F.concat(F.lit("[Source: "), F.col("_source"), F.lit("]\n# "), F.col("_title"),
                       F.lit("\n"), F.col("_content"))
    # At most k passages per question.
    blocks = (passages.groupBy(question_id)
              .agg(F.sort_array(F.collect_list(F.struct("rank", passage.alias("passage"),
                                                        F.col("_source").alias("source"))))
                   .alias("hits")))
    return blocks.select(question_id, F.array_join("hits.passage", "\n\n").alias("context"),
                         F.array_join("hits.source", ", ").alias("citations"),
                         F.size("hits").cast("long").alias("n_passages"))


def evaluate(hits: DataFrame, truth: DataFrame, answer: str, question_id: str = "query_id") -> DataFrame:
    """Share of questions whose best hit is right, and whose list holds a right answer.

    ``hits`` has question id, rank and ``answer``; ``truth`` has question id and ``expected``.
    """
    judged = hits.join(truth, question_id).withColumn(
        "_right", F.col(answer).eqNullSafe(F.col("expected")))
    per_question = judged.groupBy(question_id).agg(
        F.max(F.col("_right") & (F.col("rank") == 1)).alias("_top"),
        F.max("_right").alias("_any"), F.avg(F.col("_right").cast("double")).alias("_share"))
    asked = truth.select(question_id).join(per_question, question_id, "left")
    return asked.agg(F.count(F.lit(1)).alias("n_questions"),
                     F.round(F.avg(F.coalesce(F.col("_top").cast("double"), F.lit(0.0))), 6).alias("top1"),
                     F.round(F.avg(F.coalesce(F.col("_any").cast("double"), F.lit(0.0))), 6).alias("hit_at_k"),
                     F.round(F.avg(F.coalesce("_share", F.lit(0.0))), 6).alias("precision_at_k"))


def recall_against(approximate: DataFrame, exact: DataFrame, question_id: str = "query_id",
                   doc_id: str = "doc_id") -> DataFrame:
    """Share of exact neighbours that the approximate lists contain, per question."""
    got = approximate.select(question_id, doc_id, F.lit(1).alias("_got"))
    return (exact.select(question_id, doc_id).join(got, [question_id, doc_id], "left")
            .groupBy(question_id).agg(F.avg(F.coalesce("_got", F.lit(0))).alias("recall")))


def index_consistency(docs: DataFrame, vectors: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Documents without a vector, vectors without a document, and null vectors, by key."""
    empty = vectors.filter(F.col(vec).isNull()).select(key, F.lit("null_vector").alias("problem"))
    missing = (docs.select(key).join(key_set(vectors, [key]), [key], "left_anti")
               .select(key, F.lit("document_without_vector").alias("problem")))
    orphan = (vectors.select(key).join(key_set(docs, [key]), [key], "left_anti")
              .select(key, F.lit("vector_without_document").alias("problem")))
    return empty.unionByName(missing).unionByName(orphan)
