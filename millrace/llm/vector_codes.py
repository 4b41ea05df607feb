"""Product codes of vectors: integer k-means per part, with Drake and Hamerly's adaptive bounds.

Vectors become integers and are packed into blocks. A block's state holds, for every vector and part,
the entry it is assigned to, the ``b`` next closest entries with ordered lower bounds of their
distances, and one outer bound for all other entries; every round writes it. When entries have moved,
bounds shrink by how far. A vector whose distance to its own entry, computed in integers, is below
its bounds keeps the entry; otherwise the listed entries whose bounds do not rule them out are
compared in integers, and all entries only where the outer bound does not rule the rest out. ``b``
shrinks to what a round has needed. Ties and rounding cannot matter: bounds are only ever too low.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.skew import lookup_join
from millrace.llm.staging import bound_batches, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Listed entries per vector and part: at first, and at least.
LISTED, FEWEST = 12, 2
#: Vectors of one block.
BLOCK_ROWS = 4096
#: Components must be below this after scaling, so that squared distances fit 64 bits.
LARGEST = 1 << 28
_EXACT_FLOAT = 1 << 22
_ABOVE, _BELOW = 1 + 1e-9, 1 - 1e-9


def scaled(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their components as integers, one row each."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL becomes NaN
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(owner[~np.isfinite(values)], minlength=len(sizes)) > 0 if len(sizes) else np.zeros(0, bool)
    keep = vectors.is_valid().to_numpy(zero_copy_only=False) & ~bad
    widths = np.unique(sizes[keep])
    if len(widths) > 1 or len(widths) and (widths[0] == 0 or widths[0] % PARTS):
        raise ValueError(f"vectors need one length that {PARTS} divides, not {widths.tolist()}")
    if not len(widths):
        return keep, np.zeros((0, 0), np.int64)
    whole = np.floor(values[keep[owner]] * SCALE)
    if np.abs(whole).max() >= LARGEST:
        raise ValueError(f"components must be below {LARGEST // SCALE}")
    return keep, whole.astype(np.int64).reshape(-1, int(widths[0]))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every entry, exact."""
    kind = np.float64 if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < _EXACT_FLOAT else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


@dataclass
class Bounds:
    """State of one part of a block: assigned entry; listed entries and their lower bounds, in order; outer bound."""

    own: np.ndarray
    listed: np.ndarray
    low: np.ndarray
    outer: np.ndarray

    @classmethod
    def fresh(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """From the distances to all entries."""
        far = distances(x, entries)
        order = np.argsort(far, axis=1, kind="stable")  # ties to the lower index
        size = np.sqrt(np.take_along_axis(far, order[:, :b + 2], 1).astype(np.float64)) * _BELOW
        b = min(b, len(entries) - 1)
        outer = size[:, b + 1] if len(entries) > b + 1 else np.full(len(x), np.inf)
        return cls(order[:, 0].astype(np.uint8), order[:, 1:b + 1].astype(np.uint8), size[:, 1:b + 1], outer)

    def moved(self, shift: np.ndarray) -> Bounds:
        """Bounds that hold after every entry has moved by at most ``shift``; each holds for all later entries too."""
        outer = np.maximum(self.outer - shift.max(initial=0), 0)
        low = np.maximum(self.low - shift[self.listed], 0)
        stacked = np.minimum.accumulate(np.hstack([low, outer[:, None]])[:, ::-1], axis=1)[:, ::-1]
        return Bounds(self.own, self.listed, stacked[:, :-1], outer)

    def assign(self, x: np.ndarray, entries: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
        """The nearest entries, and how many listed ones each vector needed (one more than listed: all entries)."""
        kept = min(b, self.listed.shape[1])
        if kept < self.listed.shape[1]:  # the first entry that is dropped bounds all that follow
            self = Bounds(self.own, self.listed[:, :kept], self.low[:, :kept], np.minimum(self.low[:, kept], self.outer))
        b = kept
        own, listed, low, outer = self.own.copy(), self.listed.copy(), self.low.copy(), self.outer.copy()
        there = ((x - entries[own]) ** 2).sum(1)
        reach = np.sqrt(there.astype(np.float64)) * _ABOVE
        need = (low <= reach[:, None]).sum(1)
        need[(outer <= reach)] = b + 1
        some = np.flatnonzero((need > 0) & (need <= b))
        if len(some):
            candidates = np.hstack([own[some][:, None], listed[some]])
            far = ((x[some][:, None, :] - entries[candidates]) ** 2).sum(2)
            place = np.arange(b + 1)[None, :]
            seen = place <= need[some][:, None]
            # Those compared are the first ones, put in order of distance and index; the others stay.
            rank = np.where(seen, np.lexsort((candidates, far, ~seen), axis=1), place)
            ordered = np.take_along_axis(candidates, rank, 1)
            size = np.sqrt(np.take_along_axis(far, rank, 1).astype(np.float64)) * _BELOW
            bound = np.where(seen, size, np.hstack([np.zeros((len(some), 1)), low[some]]))
            own[some], listed[some] = ordered[:, 0], ordered[:, 1:]
            low[some] = np.minimum.accumulate(np.hstack([bound[:, 1:], outer[some][:, None]])[:, ::-1], axis=1)[:, ::-1][:, :-1]
        every = np.flatnonzero(need > b)
        if len(every):
            made = Bounds.fresh(x[every], entries, b)
            own[every], listed[every], low[every], outer[every] = made.own, made.listed, made.low, made.outer
        return Bounds(own, listed, low, outer), need

    def pack(self) -> bytes:
        """Bounds are rounded down to 16 bits of the block's largest."""
        top = np.hstack([self.low, self.outer[:, None]])
        finite = top[np.isfinite(top)]
        unit = max(float(finite.max(initial=0)) / 65_000, 1e-12)
        coarse = np.where(np.isfinite(top), np.floor(np.minimum(top, 1e300) / unit * _BELOW), 65_535).astype(np.uint16)
        head = np.array([len(self.own), self.listed.shape[1]], np.int64).tobytes() + np.float64(unit).tobytes()
        return head + self.own.tobytes() + self.listed.T.tobytes() + coarse.T.tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> Bounds:
        n, b = np.frombuffer(raw, np.int64, 2).tolist()
        unit = float(np.frombuffer(raw, np.float64, 1, 16)[0])
        own = np.frombuffer(raw, np.uint8, n, 24)
        listed = np.frombuffer(raw, np.uint8, n * b, 24 + n).reshape(b, n).T
        coarse = np.frombuffer(raw, np.uint16, n * (b + 1), 24 + n + n * b).reshape(b + 1, n).T
        fine = np.where(coarse == 65_535, np.inf, coarse * unit * _BELOW)
        return cls(own, listed, fine[:, :-1], fine[:, -1])


def _pack_rows(x: np.ndarray) -> bytes:
    small = np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32
    raw = np.array([*x.shape, np.dtype(small).itemsize], np.int64).tobytes() + np.ascontiguousarray(x.T.astype(small)).tobytes()
    return zstandard.compress(raw, 3)


def _unpack_rows(packed: bytes) -> np.ndarray:
    raw = zstandard.decompress(packed)
    n, width, size = np.frombuffer(raw, np.int64, 3).tolist()
    return np.frombuffer(raw, {2: np.int16, 4: np.int32}[size], n * width, 24).reshape(width, n).T.astype(np.int64)


def _pack_state(states: list[Bounds]) -> bytes:
    parts = [s.pack() for s in states]
    return zstandard.compress(np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts), 3)


def _unpack_state(packed: bytes) -> list[Bounds]:
    raw = zstandard.decompress(packed)
    cuts = 8 * PARTS + np.r_[0, np.cumsum(np.frombuffer(raw, np.int64, PARTS))]
    return [Bounds.unpack(raw[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def vector_blocks(rows: DataFrame) -> DataFrame:
    """id, label (arrays) and x (packed integers) of the kept vectors, in blocks; ``rows`` has id, label and vector."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                keep, x = scaled(part.column("vector"))
                if len(x):
                    mask = pa.array(keep)
                    columns = [part.column(c).filter(mask) for c in ("id", "label")]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns),
                         pa.array([_pack_rows(x)], pa.binary()), pa.array([x.shape[1]], pa.int64())], ["id", "label", "x", "width"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    return rows.mapInArrow(apply, f"id array<{kinds['id']}>, label array<{kinds['label']}>, x binary, width long")


def _states(blocks: DataFrame, books: np.ndarray, shift: np.ndarray | None, b: int) -> DataFrame:
    """Assigns every vector: x, state, and need (how many vectors needed 0, 1, ... listed entries, or all)."""
    shared = blocks.sparkSession.sparkContext.broadcast((books, shift))  # as large as the codebooks
    columns = ["id", "label", "x", "width"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, moved = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                x = _unpack_rows(batch.column("x")[i].as_py())
                wide = x.shape[1] // PARTS
                before = [None] * PARTS if moved is None else _unpack_state(batch.column("state")[i].as_py())
                made, needed = [], np.zeros(LISTED + 2, np.int64)
                for p, old in enumerate(before):
                    own = x[:, p * wide:(p + 1) * wide]
                    if old is None:
                        made.append(Bounds.fresh(own, entries[p], b))
                    else:
                        state, need = old.moved(moved[p]).assign(own, entries[p], b)
                        full = need > state.listed.shape[1]
                        needed += np.bincount(np.where(full, LISTED + 1, need), minlength=LISTED + 2)
                        made.append(state)
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c) for c in columns), pa.array([_pack_state(made)], pa.binary()), pa.array([needed.tolist()], pa.list_(pa.int64()))],
                    [*columns, "state", "need"])

    layout = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in columns)
    return staged(blocks.mapInArrow(apply, f"{layout}, state binary, need array<long>"), "vector-state")


def _sums(states: DataFrame, entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the vectors of every entry; each task adds up its own."""
    wide = width // PARTS

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, entries, wide + 1), np.int64)
        for batch in batches:
            for x, state in zip(batch.column("x").to_pylist(), batch.column("state").to_pylist()):
                x = _unpack_rows(x)
                for p, own in enumerate(_unpack_state(state)):
                    np.add.at(total[p], own.own, np.hstack([x[:, p * wide:(p + 1) * wide], np.ones((len(x), 1), np.int64)]))
        flat = total.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["k", "v"])

    out = np.zeros(PARTS * entries * (wide + 1), np.int64)
    found = states.select("x", "state").mapInArrow(apply, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out[found.column("k").to_numpy()] = found.column("v").to_numpy()
    out = out.reshape(PARTS, entries, wide + 1)
    return out[:, :, :-1], out[:, :, -1]


def adapted(need: list[int], b: int) -> int:
    """Listed entries for the next round: the most that a vector has needed which did not need all."""
    used = [z for z in range(1, b + 1) if need[z]]
    return max(FEWEST, min(b, max(used, default=0)))


def train(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (part, entry, component) after ``rounds``, and the state of the assignment to them."""
    books = np.stack([first[:, p * (first.shape[1] // PARTS):(p + 1) * (first.shape[1] // PARTS)] for p in range(PARTS)])
    b = min(LISTED, books.shape[1] - 1)
    states = _states(blocks, books, None, b)
    for _ in range(rounds):
        sums, counts = _sums(states, books.shape[1], first.shape[1])
        after = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        shift = np.sqrt(((after - books) ** 2).sum(2).astype(np.float64)) * _ABOVE
        books = after
        states = _states(states, books, shift, b)
        need = states.agg(*[F.coalesce(F.sum(F.get("need", F.lit(i))), F.lit(0)) for i in range(LISTED + 2)]).first()
        b = adapted(list(need), b) if b else 0
    return books, states


def vector_codes(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector: vec_id, label, code, error, label_error; and the codebooks.

    Vectors that are NULL or hold NULL, NaN or infinite components are dropped. Components become
    floor(1024 x). Codebooks start from the vectors with the smallest ids; a NULL id is larger than any other,
    and rows that share an id are ordered by their vector. With fewer vectors than ``entries`` there are
    as many entries as vectors. Equal labels, NULL ones together, share label_error. Vectors of
    different lengths, of a length that four does not divide, or with components of 2^18 and more
    are an error. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    narrow = rows.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    kind, label_kind = narrow.schema["id"].dataType.simpleString(), narrow.schema["label"].dataType.simpleString()
    sound = F.col("vector").isNotNull() & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    head = narrow.filter(sound).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    if not head.num_rows:
        return spark.createDataFrame([], f"{vec_id} {kind}, {label} {label_kind}, code string, error long, label_error long"), np.zeros((PARTS, 0, 0), np.int64)
    first = scaled(head.column("vector").combine_chunks())[1]
    books, states = train(staged(vector_blocks(narrow), "vectors"), first, rounds)
    wide, shared = first.shape[1] // PARTS, spark.sparkContext.broadcast(books)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        final = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                x = _unpack_rows(batch.column("x")[i].as_py())
                own = [s.own for s in _unpack_state(batch.column("state")[i].as_py())]
                error = sum(((x[:, p * wide:(p + 1) * wide] - final[p][own[p]]) ** 2).sum(1) for p in range(PARTS))
                text = np.column_stack(own).astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[i].values, batch.column("label")[i].values,
                     pa.array([text[k:k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)], pa.string()), pa.array(error)],
                    ["id", "label", "code", "error"])

    # A NULL label becomes a pair that no other label has, so that the join below finds it.
    coded = staged(states.mapInArrow(codes, f"id {kind}, label {label_kind}, code string, error long")
                   .withColumn("key", F.struct(F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("of"))), "codes")
    totals = staged(coded.groupBy("key").agg(F.sum("error").alias("label_error")), "label-errors")
    found = lookup_join(coded, totals, ["key"])
    return found.select(F.col("id").alias(vec_id), F.col("label").alias(label), "code", "error", "label_error"), books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
