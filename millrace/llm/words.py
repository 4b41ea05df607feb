"""Shared small helpers of the language-model data operators: whitespace, words, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, as a character class for regular expressions.
SPACE = r"[\x20\x09-\x0D]"
#: Maps A-Z to a-z and leaves all other bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def text_or_empty(column: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Each run of ASCII white space becomes one space. Lone spaces are left, so they cost nothing."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; NULL counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, so that memory does not follow the batch's rows."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, length in enumerate(lengths.tolist()):
            if i > start and held + length > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += length
        if batch.num_rows > start:
            yield batch.slice(start)


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word; every distinct word of the batch is hashed once."""
    if not words:
        return np.zeros(0, np.uint64)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                        np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one, so that their order and low bits are as good as random."""
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
