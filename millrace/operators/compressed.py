"""Nearest rows through product-quantised vectors: a byte per sub-space is scanned, candidates are re-ranked exactly.

A vector is cut into ``parts`` equal pieces and each piece is named by the nearest of at most 256
codebook entries. A question needs one table of distances per piece; a row's distance is then a sum
of looked-up values. Only the folders that hold candidates are opened for whole vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.skew import key_set, lookup_join, settle
from millrace.functions.vectors import BestRows, as_matrix
from millrace.operators.keyed import last_n_per_key
from millrace.operators.retrieval import SCORE_DIGITS, Scan, recall_against, scan_against
from millrace.session import ship_package

#: Most entries of a codebook: a code is one byte.
ENTRIES = 256
#: Questions sent to every task in one piece; each brings ``parts`` x ``ENTRIES`` distances.
QUESTION_BOUND = 1024
#: Most folders that vectors are stored in.
FOLDERS = 4096


def _directions(matrix: np.ndarray, metric: str) -> np.ndarray:
    """The vectors as compared: under cosine of length one, so that near in l2 is near in angle."""
    if metric != "cosine":
        return matrix
    size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    return np.divide(matrix, size, out=np.zeros_like(matrix), where=size > 0)


def _nearest(pieces: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of every piece; ties go to the lower index."""
    return np.argmin(np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * pieces @ centres.T, axis=1)


def train_codebook(pieces: np.ndarray, rounds: int, seed: int = 7) -> np.ndarray:
    """At most ``ENTRIES`` centres by Lloyd's rounds. The order of the rows does not matter; an unused entry stays."""
    pieces = pieces[np.lexsort(pieces.T[::-1])]
    known = np.unique(pieces, axis=0)
    centres = known[np.sort(np.random.default_rng(seed).permutation(len(known))[:ENTRIES])]
    for _ in range(rounds):
        place = _nearest(pieces, centres)
        used = np.bincount(place, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, place, pieces)
        centres = np.where(used[:, None] > 0, sums / np.maximum(used, 1)[:, None], centres)
    return centres


@dataclass
class PqIndex:
    """A stored index: codes of all rows, their vectors by folder, codebooks and the metric."""

    codes: DataFrame
    vectors: DataFrame
    codebooks: list[np.ndarray]
    metric: str
    slots: int

    @staticmethod
    def build(corpus: DataFrame, root: str, parts: int, doc_id: str = "doc_id", vec: str = "embedding", metric: str = "cosine",
              training: int = 65_536, rounds: int = 8, folder_rows: int = 1_000_000) -> PqIndex:
        """Learn codebooks from ``training`` rows (those with the smallest hashes of their ids), then store a code for every row.

        Each codebook is learnt in a task of its own from its piece of the sample, which is all that grows with
        ``training``. Ids are longs and must be unique; rows without an id or a vector are left out, and under
        cosine zero vectors, which are nobody's neighbours. An empty table gives an index without rows.
        """
        if metric not in ("cosine", "l2"):
            raise ValueError("an index is built for 'cosine' or 'l2'")
        spark = corpus.sparkSession
        ship_package(spark)
        rows = corpus.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(vec).alias("embedding")).dropna()
        if metric == "cosine":
            rows = rows.filter(F.exists("embedding", lambda x: x != 0))
        sizes = rows.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
        n, dims = sizes[0], sizes[1] or parts
        if sizes[1] != sizes[2] or dims % parts:
            raise ValueError(f"vectors must have one length, a multiple of {parts}")
        if rows.groupBy("doc_id").count().filter("count > 1").limit(1).count():
            raise ValueError("document ids are not unique")
        slots, width = max(1, min(FOLDERS, -(-n // folder_rows))), dims // parts

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pieces = _directions(as_matrix(batch.column(0), dims), metric).reshape(-1, width)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(parts, dtype=np.int32), len(pieces) // parts)),
                                                  pa.array(list(pieces), pa.list_(pa.float64()))], names=["part", "piece"])

        def learn(group: pd.DataFrame) -> pd.DataFrame:
            centres = train_codebook(np.stack(group["piece"].to_list()), rounds)
            return pd.DataFrame({"part": group["part"].iloc[0], "entry": np.arange(len(centres), dtype=np.int32), "centre": list(centres)})

        sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(training).select("embedding")
        kind = "part int, entry int, centre array<double>"
        (sample.mapInArrow(cut, "part int, piece array<double>").groupBy("part").applyInPandas(learn, kind)
         .withColumn("metric", F.lit(metric)).withColumn("slots", F.lit(slots)).coalesce(1).write.parquet(f"{root}/codebooks"))
        if not n:
            spark.createDataFrame([(0, 0, [0.0] * width, metric, slots)], f"{kind}, metric string, slots int").write.mode("overwrite").parquet(f"{root}/codebooks")
        books = spark.sparkContext.broadcast(PqIndex._books(spark, root)[0])

        def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                matrix = _directions(as_matrix(batch.column(1), dims), metric)
                codes = np.stack([_nearest(matrix[:, p * width:(p + 1) * width], book) for p, book in enumerate(books.value)], axis=1).astype(np.uint8)
                offsets = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
                packed = pa.BinaryArray.from_buffers(pa.binary(), len(codes), [None, offsets.buffers()[1], pa.py_buffer(codes.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "code"])

        rows.mapInArrow(encode, "doc_id long, code binary").write.parquet(f"{root}/codes")
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int")
        (rows.withColumn("slot", slot).repartition(max(slots, spark.sparkContext.defaultParallelism), "slot").sortWithinPartitions("slot", "doc_id")
         .write.partitionBy("slot").parquet(f"{root}/vectors"))
        return PqIndex.open(spark, root)

    @staticmethod
    def _books(spark: SparkSession, root: str) -> tuple[list[np.ndarray], str, int]:
        rows = spark.read.parquet(f"{root}/codebooks").orderBy("part", "entry").collect()  # ENTRIES vectors at most
        found: dict[int, list[list[float]]] = {}
        for r in rows:
            found.setdefault(r.part, []).append(r.centre)
        return [np.array(found[p]) for p in sorted(found)], rows[0].metric, rows[0].slots

    @staticmethod
    def open(spark: SparkSession, root: str) -> PqIndex:
        """Open a stored index; only the codebooks are read."""
        books, metric, slots = PqIndex._books(spark, root)
        vectors = spark.read.schema("doc_id long, embedding array<float>, slot int").parquet(f"{root}/vectors")
        return PqIndex(spark.read.schema("doc_id long, code binary").parquet(f"{root}/codes"), vectors, books, metric, slots)


def _code_scan(books: list[np.ndarray], metric: str, wanted: int, names: tuple[str, str, str]):
    def prepare(questions: pa.Table) -> Scan:
        table = questions.combine_chunks()
        ids = table.column(0).to_numpy()
        parts, width = len(books), books[0].shape[1]
        steps = np.concatenate([[0], np.cumsum([len(b) for b in books])])

        def gaps_to_entries() -> np.ndarray:
            """Squared distances of a question's pieces to all entries, one row per question."""
            asked = _directions(as_matrix(table.column(1).combine_chunks(), parts * width), metric)
            return np.concatenate([((asked[:, None, p * width:(p + 1) * width] - book[None]) ** 2).sum(axis=2)
                                   for p, book in enumerate(books)], axis=1).astype(np.float32)

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, gaps = BestRows(len(ids), wanted), None
            for batch in batches:
                if not batch.num_rows or not len(ids):
                    continue
                gaps = gaps_to_entries() if gaps is None else gaps
                row_ids = batch.column(0).to_numpy()
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts) + steps[:-1]
                for question in range(len(ids)):
                    best.offer(question, gaps[question][codes].sum(axis=1, dtype=np.float64), row_ids)
            yield best.batch(ids, names)

        return scan

    return prepare


def knn_pq(questions: DataFrame, index: PqIndex, k: int, depth: int, question_id: str = "query_id", question_vec: str = "embedding",
           rank_as: str = "rank", bound: int = QUESTION_BOUND) -> DataFrame:
    """Approximate ``k`` nearest rows: the ``k * depth`` best by code, ranked by their exact distances.

    ``depth`` is the recall dial; with as many candidates as rows the answer is exact. A question without a vector, or
    under cosine with a zero vector, has no answer. Returns question id, ``doc_id``, ``distance`` and the rank.
    """
    spark, metric = questions.sparkSession, index.metric
    asked = (questions.select(F.col(question_id).cast("long").alias(question_id), F.col(question_vec).alias("_asked")).dropna())
    if metric == "cosine":
        asked = asked.filter(F.exists("_asked", lambda x: x != 0))
    names = (question_id, "doc_id", "_near")
    found = scan_against(index.codes, asked, question_id, _code_scan(index.codebooks, metric, k * depth, names),
                         f"{question_id} long, doc_id long, _near double", bound)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(index.slots)).cast("int")
    best = last_n_per_key(found, [question_id], [F.col("_near"), F.col("doc_id")], k * depth)
    best = settle(best.select(question_id, "doc_id", slot.alias("slot")))
    near = lookup_join(index.vectors, key_set(best, ["slot", "doc_id"]), ["slot", "doc_id"], "left_semi").drop("slot")
    pairs = lookup_join(lookup_join(best.drop("slot"), near, ["doc_id"]), asked, [question_id])
    ship_package(spark)

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = len(batch.column(2)[0])
            a, b = as_matrix(batch.column(2), dims), as_matrix(batch.column(3), dims)
            if metric == "cosine":
                gaps = 1.0 - np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
            else:
                gaps = np.sqrt(np.einsum("ij,ij->i", a - b, a - b))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.round(gaps, SCORE_DIGITS))],
                                             names=[question_id, "doc_id", "distance"])

    ranked = pairs.select(question_id, "doc_id", "embedding", "_asked").mapInArrow(rank, f"{question_id} long, doc_id long, distance double")
    return last_n_per_key(ranked, [question_id], [F.col("distance"), F.col("doc_id")], k, rank_as=rank_as)


def depth_for(questions: DataFrame, index: PqIndex, exact: DataFrame, k: int, recall: float = 0.9, question_id: str = "query_id",
              most: int = 1024, **names: str) -> int:
    """Least depth, among powers of two up to ``most``, that finds this share of the ``exact`` neighbours."""
    depth = 1
    while depth < most:
        found = knn_pq(questions, index, k, depth, question_id=question_id, **names)
        if (recall_against(found, exact, question_id).agg(F.avg("recall")).first()[0] or 0.0) >= recall:
            break
        depth *= 2
    return depth
