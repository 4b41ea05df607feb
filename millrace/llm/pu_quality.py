"""Quality from positive and unlabelled text: the non-negative unbiased risk, minimised by Newton steps.

With logistic loss, prior ``pi``, trusted positives P and unlabelled text U the unbiased risk is
``pi E_P[l(z)] + (E_U[l(-z)] - pi E_P[l(-z)])``. Its second part estimates the risk on bad text and
cannot be below zero; steps that would take it there are shortened. The features are shares of
character and word classes, so every language and length is judged alike. All rows of the table are
unlabelled text; every step sums over all of them on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import bound_batches, staged
from millrace.llm.words import utf8

THRESHOLD = 0.3
#: Newton steps at most, and the weight of the squared coefficients.
STEPS, RIDGE = 12, 1e-3
#: Cells (as bits) that runs of three bytes are hashed to.
RUN_BITS = 16
#: Thresholds tried for the prior, over scores whose logit is within REACH; chance of a wrong bound, and its weight.
GRID, REACH, CHANCE, CARE = 4096, 12.0, 0.1, 0.01
_PLAIN_MARKS = b".,;:'\"-()?"
_CLASSES = np.array([0 if b >= 128 else 1 if chr(b).isupper() else 2 if chr(b).islower() else 3 if chr(b).isdigit()
                     else 4 if chr(b).isspace() else 5 if b in _PLAIN_MARKS else 6 if chr(b) == "!" else 7 if chr(b) == "|"
                     else 8 for b in range(256)])
_ODD_ENDS = frozenset(b for b in range(128) if not chr(b).isalnum() and b not in _PLAIN_MARKS)


def measures(text: bytes) -> list[float]:
    """Shares of capitals, digits, marks, exclamations, bars and other signs; of repeated neighbours,
    oddly ended words and repeated lines; variety of words; logarithm of their number; bytes per word."""
    size, words = max(1, len(text)), text.lower().split()
    counts = np.zeros(9, np.int64)
    for at in range(0, len(text), 1 << 20):
        counts += np.bincount(_CLASSES[np.frombuffer(text[at:at + (1 << 20)], np.uint8)], minlength=9)
    n = max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [counts[1] / max(1, counts[0] + counts[1] + counts[2]), *(counts[[3, 5, 6, 7, 8]] / size),
            sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1),
            sum(w[-1] in _ODD_ENDS for w in words) / n,
            1 - len(set(lines)) / max(1, len(lines)),
            len(set(words)) / n ** 0.75, np.log1p(len(words)), min(size / n, 1000.0)]


def runs(text: bytes) -> Iterator[np.ndarray]:
    """Cells of the text's runs of three bytes, a piece of the text at a time."""
    for at in range(0, len(text) - 2, 1 << 20):
        b = np.frombuffer(text[at:at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        yield (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - RUN_BITS)).astype(np.int64)


def usual(text: bytes, letters: np.ndarray) -> float:
    """Mean of the log probabilities of the text's runs; a text without one is as usual as an even draw."""
    total, n = 0.0, 0
    for cells in runs(text):
        total, n = total + float(letters[cells].sum()), n + len(cells)
    return total / n if n else -RUN_BITS * np.log(2)


def features(texts: list[bytes], letters: np.ndarray) -> np.ndarray:
    raw = np.array([measures(t) for t in texts], float).reshape(len(texts), 12)
    known = np.array([usual(t, letters) for t in texts], float).reshape(len(texts), 1)
    return np.hstack([raw, np.log1p(50 * raw[:, :9]), raw[:, 9:11] ** 2, known])


WIDTH = 24


@dataclass(frozen=True)
class Model:
    """Weights over standardised features; the last weight is the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float
    letters: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.standard(x) @ self.weights, -500, 500)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def fold(ident: Column, parts: int = 5) -> Column:
    """crc32 of the id's text modulo ``parts``; NULL for a NULL id."""
    return F.crc32(ident.cast("string")) % parts


def letter_table(docs: DataFrame) -> np.ndarray:
    """Log probability of every cell of runs, add-one, from all texts. Without texts all cells are alike."""
    size = 1 << RUN_BITS

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for text in utf8(batch.column("text")):
                for cells in runs(text):
                    total += np.bincount(cells, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["k", "v"])

    bound_batches(docs.sparkSession)
    counts = np.zeros(size)
    for k, v in docs.select("text").mapInArrow(apply, "k long, v long").groupBy("k").agg(F.sum("v")).collect():  # at most ``size`` rows
        counts[k] = v
    return np.log((counts + 1) / (counts.sum() + size))


def featured(docs: DataFrame, letters: np.ndarray) -> DataFrame:
    """doc_id, x: the features of every text, written once; NULL counts as empty."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(utf8(batch.column("text")), letters)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["doc_id", "x"])

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return staged(docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, x array<double>"), "features")


def _sums(rows: DataFrame, function, size: int) -> np.ndarray:
    """Sum over all rows of ``function(x, trusted)``, a vector of ``size``; each task sums its own."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)
                total += function(x, batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["k", "v"])

    out = np.zeros(size)
    for k, v in rows.select("x", "trusted").mapInArrow(apply, "k long, v double").groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out


def lowest_ratio(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good text in the unlabelled, from two histograms over rising scores.

    At every threshold the share of the unlabelled above it, over that of the trusted, is at least the
    prior. The ratio is taken where it is lowest after adding what chance may have added to it.
    """
    p, u = trusted[::-1].cumsum(), unlabelled[::-1].cumsum()
    above = p > 0
    spread = sum(np.sqrt(np.log(4 / CHANCE) / 2 / n[-1]) for n in (p, u))
    p, u = p[above] / p[-1], u[above] / u[-1]
    best = int(np.argmin(u / p + (1 + CARE) * spread / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def estimate_prior(rows: DataFrame, model: Model) -> float:
    """:func:`lowest_ratio` over the model's scores of all rows."""
    def histograms(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        cell = ((np.clip(model.logit(x), -REACH, REACH) + REACH) / (2 * REACH) * (GRID - 1)).astype(int)
        return np.concatenate([np.bincount(cell[p], minlength=GRID), np.bincount(cell, minlength=GRID)])

    return lowest_ratio(*_sums(rows, histograms, 2 * GRID).reshape(2, GRID))


def fit(rows: DataFrame, labels: DataFrame, letters: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Fits on rows of ``featured`` with the same ``letters``. Only labels with fold 1 to 4 that say 1 or 0 are looked at.

    A document with several labels is trusted only if all say 1; a label 0 has no other use. The model
    is first fitted with a prior of a half, whose scores give the estimate, then with the estimate.
    Without documents, or without a trusted one, all weights are 0 and every score is 0.5.
    """
    known = (labels.filter((fold(F.col("doc_id")) != 0) & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("_doc")).agg(F.min("quality").alias("quality")))
    rows = staged(rows.join(known, F.col("doc_id") == F.col("_doc"), "left")
                  .select("x", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("trusted")), "training")
    moments = _sums(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * WIDTH)
    n, good = moments[:2]
    if not n or not good:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), 0.5, letters)
    mean = moments[2:WIDTH + 2] / n
    scale = np.sqrt(np.maximum(moments[WIDTH + 2:] / n - mean ** 2, 0)) + 1e-9
    first = descend(rows, n, good, Model(mean, scale, np.zeros(WIDTH + 1), 0.5, letters), steps, ridge)
    return descend(rows, n, good, replace(first, prior=estimate_prior(rows, first), weights=np.zeros(WIDTH + 1)), steps, ridge)


def descend(rows: DataFrame, n: float, good: float, model: Model, steps: int, ridge: float) -> Model:
    """Newton steps on the risk of ``n`` rows, ``good`` of them trusted, from the model's weights and with its prior."""
    prior, wide = model.prior, WIDTH + 1
    halves = 0.5 ** np.arange(8)
    for _ in range(steps):
        def slope(x: np.ndarray, p: np.ndarray, model: Model = model) -> np.ndarray:
            z, s = model.standard(x), model.score(x)
            return np.concatenate([z[p].sum(0), (s[:, None] * z).sum(0), (z.T @ (z * (s * (1 - s))[:, None])).ravel()])

        got = _sums(rows, slope, 2 * wide + wide * wide)
        gradient = -prior * got[:wide] / good + got[wide:2 * wide] / n + ridge * model.weights
        bend = got[2 * wide:].reshape(wide, wide) / n + ridge * np.eye(wide)
        step = np.linalg.solve(bend, gradient)
        tried = np.vstack([model.weights, *(model.weights - h * step for h in halves)])

        def risks(x: np.ndarray, p: np.ndarray, model: Model = model, tried: np.ndarray = tried) -> np.ndarray:
            z = model.standard(x) @ tried.T
            return np.concatenate([np.logaddexp(0, -z[p]).sum(0), np.logaddexp(0, z[p]).sum(0), np.logaddexp(0, z).sum(0)])

        positive, swapped, unlabelled = _sums(rows, risks, 3 * len(tried)).reshape(3, -1)
        bad = unlabelled / n - prior * swapped / good  # the part that must not fall below zero
        risk = prior * positive / good + np.maximum(bad, 0) + ridge / 2 * (tried ** 2).sum(1)
        better = [k for k in range(1, len(tried)) if bad[k] >= 0 and risk[k] < risk[0] - 1e-9]
        if not better:
            break
        best = better[int(np.argmin(risk[better]))]
        moved = np.abs(tried[best] - model.weights).max()
        model = replace(model, weights=np.round(tried[best], 9))
        if moved < 1e-5:
            break
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of ``featured`` rows."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns; no shuffle."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(model.score(features(utf8(batch.column("text")), model.letters)) >= threshold))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(apply, docs.schema)
