"""Documents packed into blocks of bounded size, and compressed lists that travel between blocks and slices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from millrace.llm.words import utf8

#: Text of one block. A block holds whole documents, so a longer document is a block by itself.
BLOCK_BYTES = 3 << 20


def pack(parts: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, parts), np.uint32, len(parts))
    return zstandard.compress(np.uint32(len(parts)).tobytes() + sizes.tobytes() + b"".join(parts), 3)


def unpack(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    cuts = [4 + 4 * n, *(4 + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64)).tolist()]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def pack_numbers(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned 64-bit numbers, byte plane by byte plane; ascending ones as differences."""
    values = np.ascontiguousarray(values, np.uint64)
    if ascending:
        values = np.diff(values, prepend=np.uint64(0))
    return zstandard.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def unpack_numbers(packed: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def blocks(docs: DataFrame, columns: Sequence[str] = ("doc_id",), size: int = BLOCK_BYTES) -> DataFrame:
    """Packs rows in the order they are read: block (hash of what it holds), an array per column, texts."""
    columns = list(columns)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, held = [], [], 0

        def block() -> pa.RecordBatch:
            packed = pack(texts)
            name = hashlib.blake2b(repr(rows).encode() + packed, digest_size=16).digest()
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.binary()), *(pa.array([[r[i] for r in rows]], pa.list_(k)) for i, k in enumerate(kinds)),
                 pa.array([packed], pa.binary())], ["block", *columns, "texts"])

        for batch in batches:
            kinds = [batch.column(c).type for c in columns]
            for row, text in zip(zip(*(batch.column(c).to_pylist() for c in columns)), utf8(batch.column("text"))):
                if texts and held + len(text) > size:
                    yield block()
                    rows, texts, held = [], [], 0
                rows.append(row)
                texts.append(text)
                held += len(text)
        if texts:
            yield block()

    layout = ", ".join(f"`{c}` array<{docs.schema[c].dataType.simpleString()}>" for c in columns)
    return docs.select(*columns, "text").mapInArrow(apply, f"block binary, {layout}, texts binary")
