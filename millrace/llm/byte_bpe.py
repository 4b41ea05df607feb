"""Byte-level BPE: every distinct pre-token of the corpus is encoded once.

Documents are packed into blocks. Each block sends its distinct pre-tokens to slices of the
vocabulary (a global shuffle of distinct words), a slice encodes every word once and sends the ids
back to the blocks that asked, and a block puts its documents together again by pre-token position.
Where the pattern lets a text be cut at single spaces, each distinct segment of a block is cut into pre-tokens once.
Lists of words and ids travel compressed, one row per block and slice. Decoding joins ids with the
token-byte table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import blocks, pack, unpack
from millrace.llm.staging import bound_batches

#: Most slices of the distinct words.
MOST_SLICES = 4096
_BREAK, _BLANK = regex.compile(r" (?=\S)"), pa.array(["", *regex.findall(r"\s", "".join(map(chr, range(0x3100))))], pa.large_string())


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes to rank, and the pattern that cuts text into pre-tokens. Its size is the tokenizer's.

    ``spaced`` says that cutting a text before a space that no blank follows changes none of its matches.
    """

    ranks: dict[bytes, int]
    pattern: str
    spaced: bool = False

    @classmethod
    def load(cls, path: str, pattern: str, spaced: bool = False) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}, pattern, spaced)


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges the neighbouring pair of lowest rank, leftmost first, until no pair has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    size = len(word)
    end = list(range(1, size + 1))  # end of the piece that starts here
    left = list(range(-1, size - 1))  # start of the piece before it
    heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= size or end[middle] != stop:
            continue  # one of the two pieces has been merged meanwhile
        end[i], end[middle] = stop, 0
        if stop < size:
            left[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(word[left[i]:stop])) is not None:
            heapq.heappush(heap, (r, left[i], stop))
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at:end[at]]])
        at = end[at]
    return out


def _pack_ids(ids: list[list[int]]) -> bytes:
    sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
    flat = np.fromiter((i for word in ids for i in word), np.uint32, int(sizes.sum()))
    return zstandard.compress(np.uint32(len(ids)).tobytes() + sizes.tobytes() + flat.tobytes(), 3)


def _unpack_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(packed)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    return np.frombuffer(raw, np.uint32, n, 4), np.frombuffer(raw, np.uint32, -1, 4 + 4 * n)


def cut_texts(texts: list[str], vocabulary: Vocabulary) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of the distinct segments of some texts, and how many each has; the segments' places in the texts, and how many each text has.

    A segment begins with a text, or with a space that no blank follows if the vocabulary is ``spaced``.
    """
    cut, n = regex.compile(vocabulary.pattern).findall, len(texts)
    if not vocabulary.spaced or not n:
        heads, inner, places, counts = texts, pa.array([], pa.large_string()), np.arange(n), np.ones(n, np.int64)
    else:
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        blank = pc.is_in(pc.utf8_slice_codeunits(coded.dictionary, 0, 1), _BLANK).to_numpy(zero_copy_only=False)
        odd = np.unique(np.repeat(np.arange(n), lists.value_lengths().to_numpy())[blank[coded.indices.to_numpy()]]) if blank.any() else []
        if len(odd):  # spaces before blanks or at an end
            order = np.arange(n)
            order[odd] = n + np.arange(len(odd))
            lists = pa.concat_arrays([lists, pa.array([_BREAK.split(texts[i]) for i in odd.tolist()], lists.type)]).take(pa.array(order))
            coded = lists.flatten().dictionary_encode()
        counts, places = lists.value_lengths().to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64)
        first = np.cumsum(counts) - counts  # has no space before it
        heads = coded.dictionary.take(pa.array(places[first])).to_pylist()
        places[first] = -1
        used = np.bincount(places + 1, minlength=len(coded.dictionary) + 1)[1:] > 0
        inner = coded.dictionary.filter(pa.array(used))
        places = (np.r_[np.cumsum(used), 0] - 1 + n)[places]
        places[first] = np.arange(n)
    pieces = [cut(h) for h in heads]
    words = [w for p in pieces for w in p]
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    if len(inner):
        own = cut(" " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner.cast(pa.string())), " ")[0].as_py())
        words += own
        ends = np.cumsum(pc.utf8_length(inner).to_numpy() + 1)
        sizes = np.r_[sizes, np.diff(np.searchsorted(np.cumsum(np.fromiter(map(len, own), np.int64, len(own))), ends, "right"), prepend=0)]
    return words, sizes, places, counts


def distinct_words(pieces: list[list[str]]) -> tuple[list[bytes], np.ndarray]:
    """Distinct pre-tokens of some texts, and for every occurrence its place among them."""
    place: dict[str, int] = {}
    known = place.setdefault
    occurs = np.fromiter((known(w, len(place)) for p in pieces for w in p), np.int64, sum(map(len, pieces)))
    return [w.encode() for w in place], occurs


def by_slice(words: Collection[bytes], slices: int) -> list[tuple[int, list[bytes]]]:
    """Distinct words in sorted order, by the slice that their hash names."""
    ordered = sorted(words)
    at = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ordered), np.uint64, len(ordered)) % np.uint64(slices)
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(slices + 1)).tolist()
    return [(s, [ordered[i] for i in order[a:b].tolist()]) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def encode(docs: DataFrame, vocabulary: Vocabulary, slices: int | None = None, decoded: bool = False) -> DataFrame:
    """doc_id, ids (array<int>) of every row, as if each text had been encoded by itself.

    NULL and empty texts have no ids. Rows that are repeated or share a doc_id are encoded one by
    one. Bytes that are not UTF-8 are read as U+FFFD. An empty table gives an empty result; other
    columns of ``docs`` are ignored. With ``decoded`` the ids are decoded again where they are, as :func:`decode` would.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    slices = slices or min(MOST_SLICES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(vocabulary)  # as large as the tokenizer, whatever the corpus
    packed = blocks(docs)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts").to_pylist()):
                found = set(cut_texts([t.decode("utf-8", "replace") for t in unpack(texts)], shared.value)[0])
                rows = by_slice([w.encode() for w in found], slices)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.binary()),
                     pa.array([pack(w) for _, w in rows], pa.binary())], ["slice", "block", "words"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, here, known = shared.value.ranks, None, {}
        for batch in batches:
            coded = []
            for at, words in zip(batch.column("slice").to_pylist(), batch.column("words").to_pylist()):
                if at != here:
                    here, known = at, {}
                ids = []
                for word in unpack(words):
                    own = known.get(word)
                    if own is None:
                        own = known[word] = encode_word(word, ranks)
                    ids.append(own)
                coded.append(_pack_ids(ids))
            yield pa.RecordBatch.from_arrays([batch.column("slice"), batch.column("block"), pa.array(coded, pa.binary())],
                                             ["slice", "block", "coded"])

    answers = (packed.mapInArrow(ask, "slice int, block binary, words binary")
               .repartition(slices, "slice").sortWithinPartitions("slice")
               .mapInArrow(answer, "slice int, block binary, coded binary"))

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = left.schema.field("doc_id").type.value_type
        coded = dict(zip(right.column("slice").to_pylist(), right.column("coded").to_pylist()))
        ids, rows, back = [], [], []
        tokens = token_table(shared.value) if decoded else None
        for names, texts in zip(left.column("doc_id").to_pylist(), left.column("texts").to_pylist()):
            words, lengths, places, counts = cut_texts([t.decode("utf-8", "replace") for t in unpack(texts)], shared.value)
            found, occurs = distinct_words([words])
            place: dict[bytes, int] = {}
            sizes, flat = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
            for at, own in by_slice(found, slices):
                for word in own:
                    place[word] = len(place)
                n, values = _unpack_ids(coded[at])
                sizes.append(n)
                flat.append(values)
            ends = np.r_[0, np.cumsum(np.concatenate(sizes), dtype=np.int64)]
            table = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype(np.int32)))
            order = np.fromiter((place[w] for w in found), np.int64, len(found))[occurs]
            taken = table.take(pa.array(order))
            at = np.r_[0, np.cumsum(lengths)]  # segment by segment, then text by text
            taken = pa.LargeListArray.from_arrays(pa.array(taken.offsets.to_numpy()[at]), taken.values).take(pa.array(places))
            offsets = taken.offsets.to_numpy()[np.r_[0, np.cumsum(counts)]]
            values = taken.values
            ids.extend(names)
            rows.append(pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0]), values.slice(offsets[0], offsets[-1] - offsets[0])))
            if decoded:
                back.append(decode_lists(rows[-1], tokens))
        columns = [pa.array(ids, kind), pa.concat_arrays(rows).cast(pa.list_(pa.int32()))]
        return pa.table([*columns, *([pa.concat_arrays(back)] if decoded else [])], ["doc_id", "ids", "decoded"][:2 + decoded])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (packed.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(assemble, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded))


def token_table(vocabulary: Vocabulary) -> pa.Array:
    """Bytes of each token, by its id."""
    table: list[bytes | None] = [None] * (max(vocabulary.ranks.values()) + 1)
    for token, rank in vocabulary.ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def decode_lists(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    """Bytes of each list of ids, joined from the token-byte table; NULL stays NULL."""
    joined = pc.take(tokens, lists.flatten())
    at = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)[at]
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets.tobytes()), joined.buffers()[2]])
    return pc.if_else(lists.is_valid(), data, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def decode(coded: DataFrame, vocabulary: Vocabulary, column: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary) to ``coded``: the bytes of its ids, from the token-byte table.

    NULL ids decode to NULL, no ids to no bytes. A column ``decoded`` of ``coded`` is replaced.
    """
    coded = coded.drop("decoded")
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(shared.value)
        for batch in batches:
            yield batch.append_column("decoded", decode_lists(batch.column(column), tokens))

    return coded.mapInArrow(apply, f"{layout}, decoded binary")
