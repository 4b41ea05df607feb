"""Vector distances as column expressions, and the batch kernel that ranks many vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "l2", "negative_inner_product")


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two float arrays, accumulated in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def distance(a: str | Column, b: str | Column, metric: str = "cosine") -> Column:
    """Distance between two array columns of equal length; NULL for a missing vector, and under
    cosine for a zero vector, which has no direction."""
    if metric == "cosine":
        return F.lit(1.0) - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    if metric == "l2":
        squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                             * (x.cast("double") - y.cast("double")))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
    if metric == "negative_inner_product":
        return -dot(a, b)
    raise ValueError(f"metric must be one of {METRICS}")


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix; every row must have ``dims`` values."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and not (lengths == dims).all():
        raise ValueError(f"expected vectors of {dims} values")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(lengths), dims)


def pairwise(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``left`` to every row of ``right``."""
    inner = left @ right.T
    if metric == "negative_inner_product":
        return -inner
    left_sq = np.einsum("ij,ij->i", left, left)
    right_sq = np.einsum("ij,ij->i", right, right)
    if metric == "cosine":
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1.0 - inner / (np.sqrt(left_sq)[:, None] * np.sqrt(right_sq)[None, :])
    if metric == "l2":
        out = np.empty_like(inner)
        for j, row in enumerate(right):
            gap = left - row
            out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return out
    raise ValueError(f"metric must be one of {METRICS}")


class BestRows:
    """Running best-k rows per query while a task walks through its batches.

    Smaller scores are better; equal scores are ordered by id. An undefined score (a zero
    vector under cosine) is not a neighbour of anything. Memory is queries x k.
    """

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = [np.empty(0) for _ in range(queries)]
        self.ids = [np.empty(0, dtype=np.int64) for _ in range(queries)]

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        defined = ~np.isnan(scores)
        if not defined.all():
            scores, ids = scores[defined], ids[defined]
        if not len(scores):
            return
        if len(self.scores[query]) == self.k:
            keep = scores <= self.scores[query][-1]
            if not keep.any():
                return
            scores, ids = scores[keep], ids[keep]
        elif len(scores) > self.k:
            edge = np.partition(scores, self.k - 1)[self.k - 1]
            keep = scores <= edge
            scores, ids = scores[keep], ids[keep]
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]

    def batch(self, query_ids: np.ndarray, names: tuple[str, str, str]) -> pa.RecordBatch:
        counts = [len(s) for s in self.scores]
        owner = np.repeat(np.asarray(query_ids, dtype=np.int64), counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(np.concatenate([np.empty(0, np.int64), *self.ids])),
             pa.array(np.concatenate([np.empty(0), *self.scores]))],
            names=list(names))
