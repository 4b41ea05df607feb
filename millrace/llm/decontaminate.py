"""Benchmark passages in training text, found by one Aho-Corasick automaton.

The automaton holds every window of 13 consecutive words of every test item, over normalised text;
each document is normalised, scanned once, and its matches are mapped back to word positions and to
character offsets of the original text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.staging import bound_batches
from millrace.llm.words import LOWER, utf8

WINDOW = 13
#: Text of test items that one automaton holds (about 250 MB of nodes); more is scanned in slices.
AUTOMATON_BYTES = 1 << 19
#: ASCII bytes outside 0-9, A-Z and a-z separate words; A-Z are lower-cased; bytes of other scripts stay.
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """Every run of ``size`` words; all words of a shorter, non-empty text."""
    words = normal_words(text)
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def automaton(items: list[tuple[object, bytes]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Automaton over all windows; a window's value is its word count and the items that hold it."""
    owners: dict[bytes, set] = {}
    for item, text in items:
        for window in windows(text, size):
            owners.setdefault(window, set()).add(item)
    built = ahocorasick.Automaton()
    for window, ids in owners.items():
        built.add_word(f" {window.decode("utf-8", "surrogateescape")} ", (window.count(b" ") + 1, tuple(ids)))
    built.make_automaton()
    return built


def scan(text: bytes, built: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, hit spans as word positions [from, to), and the items found."""
    words = normal_words(text)
    if not words or not len(built):
        return len(words), [], set()
    line = f" {b' '.join(words).decode('utf-8', 'surrogateescape')} "
    spans, items, ends = [], set(), None
    for end, (size, ids) in built.iter(line):
        if ends is None:  # position of the space after each word
            ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)[1:]
        last = int(np.searchsorted(ends, end)) + 1
        if spans and last - size <= spans[-1][1] and spans[-1][0] <= last - size:
            spans[-1] = (spans[-1][0], max(last, spans[-1][1]))
        else:
            spans.append((last - size, last))
        items.update(ids)
    return len(words), _joined(spans), items


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_offsets(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of spans given in words."""
    letters = np.frombuffer(text.translate(_PLAIN), np.uint8) != 0x20
    edge = np.diff(np.r_[False, letters, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # characters up to each byte
    return [(int(chars[starts[a]]) - 1, int(chars[ends[b - 1] - 1])) for a, b in spans]


def _slices(items: DataFrame, limit: int) -> list[list[tuple[object, bytes]]]:
    """Test items in slices of bounded text. The benchmark is the stated query set."""
    out, size = [[]], 0
    for item, text in items.toLocalIterator():
        raw = bytes(text or b"")
        if out[-1] and size + len(raw) > limit:
            out.append([])
            size = 0
        out[-1].append((item, raw))
        size += len(raw)
    return out


def find_passages(docs: DataFrame, items: DataFrame, size: int = WINDOW, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """Adds n_words, spans (words and characters of the original), n_hit and items to ``docs``.

    ``items`` has item_id and text. NULL and empty texts have no words, no spans and no items. A
    benchmark over ``limit`` bytes is scanned slice by slice, every slice over all documents, and
    the spans are united. Bytes that are not UTF-8 count as letters and match only themselves. Column names n_words, n_hit, spans and items of ``docs`` are replaced.
    """
    bound_batches(docs.sparkSession)
    item_type, item_arrow = items.schema["item_id"].dataType.simpleString(), to_arrow_type(items.schema["item_id"].dataType)
    span_type = "array<struct<word_from:int,word_to:int,char_from:int,char_to:int>>"
    added = f"n_words long, n_hit long, spans {span_type}, items array<{item_type}>"
    out = docs.drop("n_words", "n_hit", "spans", "items")
    for k, part in enumerate(_slices(items.select("item_id", F.col("text").cast("binary").alias("text")), limit)):
        columns = [c for c in out.columns if c not in ("n_words", "n_hit", "spans", "items")]
        known = k > 0
        context = docs.sparkSession.sparkContext
        shared = context.broadcast(part)

        def apply(batches: Iterator[pa.RecordBatch], shared=shared, known=known, columns=columns) -> Iterator[pa.RecordBatch]:
            built = automaton(shared.value, size)
            for batch in batches:
                counts, hits, spans, found = [], [], [], []
                before = batch.column("spans").to_pylist() if known else None
                owners = batch.column("items").to_pylist() if known else None
                for i, text in enumerate(utf8(batch.column("text"))):
                    n, own, ids = scan(text, built)
                    if known:
                        own = _joined([*own, *((s["word_from"], s["word_to"]) for s in before[i])])
                        ids |= set(owners[i])
                    counts.append(n)
                    hits.append(sum(b - a for a, b in own))
                    spans.append([{"word_from": a, "word_to": b, "char_from": c, "char_to": d}
                                  for (a, b), (c, d) in zip(own, original_offsets(text, own))] if own else [])
                    found.append(sorted(i for i in ids if i is not None))
                kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("word_from", "word_to", "char_from", "char_to")]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()),
                     pa.array(spans, kind), pa.array(found, pa.list_(item_arrow))],
                    [*columns, "n_words", "n_hit", "spans", "items"])

        layout = ", ".join(f"`{c}` {out.schema[c].dataType.simpleString()}" for c in columns)
        out = out.mapInArrow(apply, f"{layout}, {added}")
    return out


def contaminated() -> Column:
    """At least a twentieth of the words, and at least one, lie in test passages."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*others, F.lit(0).alias("_")).alias("row"))
    return find_passages(rows, items).filter(~contaminated()).select(
        *[F.col(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
