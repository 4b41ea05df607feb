"""Frequent phrases and their cohesion, mined as SETM does: by relations of occurrences.

Pieces of text (between punctuation marks and line ends) are packed into blocks. A block's row holds
its occurrence relation sorted by piece and position, and the distinct groups of that relation with
their counts. Every length takes the same three steps: the groups are counted over all blocks, the
relation is semi-joined with the frequent ones, and a merge-join of the relation with itself at the
next position of the same piece gives the occurrences that are one word longer. Each relation is
written before the next step reads it. A phrase of k + 1 words is the pair of the phrases of its
first and its last k words, so a group is named by two numbers and never by a hash.

A block's places, codes and groups are packed lists of bytes, and a file has few blocks, as Spark
reads and writes the lists of a whole file at once: a task's memory does not follow its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.skew import lookup_join
from millrace.llm.blocks import pack_numbers, unpack_numbers
from millrace.llm.staging import bound_batches, staged
from millrace.llm.words import LOWER, mix, utf8

#: Occurrences that make a phrase a candidate; words of the longest; rows of each language in the result.
SUPPORT, LONGEST, BEST = 100, 5, 2000
#: Text of one block.
BLOCK_BYTES = 2 << 20
#: Blocks of one file.
FILE_BLOCKS = 8
#: Frequent groups, and bytes of their words, up to which they are sent to every task (16 bytes a pair); more are looked up in slices.
GROUP_BOUND, WORD_BYTES = 2_000_000, 16 << 20
#: File size up to which the phrases one word shorter are broadcast; in memory they are some twenty times larger.
LOOKUP_BYTES = 4 << 20
#: Pairs that a task adds up before it sends them, and pairs of one slice.
TASK_PAIRS, SLICE_PAIRS = 1_000_000, 1_500_000
_MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = LOWER.translate(bytes(0x20 if b in _MARKS else b for b in range(256)))
_KIND = np.array([2 if b in _MARKS else 1 if b in b" \t" else 0 for b in range(256)], np.uint8)
_NO_LANG = b"und"


def words_and_places(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words in order, and their places: neighbours in one piece are one apart, others more."""
    kind = _KIND[np.frombuffer(text, np.uint8)]
    starts = np.flatnonzero((kind == 0) & (np.r_[np.uint8(1), kind[:-1]] != 0)) if len(kind) else np.zeros(0, np.int64)
    marks = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    return text.translate(_PLAIN).split(), np.arange(len(starts), dtype=np.int64) + marks


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values), kind))


def occurrences(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """The relation of length one: block, places, codes (places and groups of all occurrences, packed), names (word,
    space, language), counts; langs and totals (words of each language)."""
    def block(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch | None:
        names, codes, places, counts, langs, totals = [], [], [], [], [], []
        base = 0
        for lang in sorted({lang for lang, _ in rows}):
            words, at = words_and_places(b"\n".join(text for own, text in rows if own == lang))
            if not words:
                continue
            coded = pa.array(words, pa.binary()).dictionary_encode()
            own = coded.indices.to_numpy().astype(np.int32)
            codes.append(own + len(names))
            places.append(at + base)
            base += int(at[-1]) + 2
            counts.append(np.bincount(own, minlength=len(coded.dictionary)))
            names += [w + b" " + lang for w in coded.dictionary.to_pylist()]
            langs.append(lang)
            totals.append(len(words))
        if not names:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([pack_numbers(np.concatenate(places), True)]), pa.array([pack_numbers(np.concatenate(codes))]), pa.array([names], pa.list_(pa.binary())),
             _lists([np.concatenate(counts)], pa.int64()), pa.array([langs], pa.list_(pa.binary())), pa.array([totals], pa.list_(pa.int64()))],
            ["places", "codes", "names", "counts", "langs", "totals"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").cast(pa.binary()).to_pylist(), utf8(batch.column("text"))):
                rows.append((_NO_LANG if lang is None else lang, text))
                held += len(text)
                if held >= size:
                    if made := block(rows):
                        yield made
                    rows, held = [], 0
        if rows and (made := block(rows)):
            yield made

    made = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        apply, "places binary, codes binary, names array<binary>, counts array<long>, langs array<binary>, totals array<long>")
    return _relation(made.withColumn("block", F.monotonically_increasing_id()))


def _relation(made: DataFrame) -> DataFrame:
    """Writes a relation, few blocks to a file."""
    return staged(made, "occurrences", rows=FILE_BLOCKS)


def _unique_pairs(left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, and their counts added up."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.ones(len(order), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    starts = np.flatnonzero(first)
    return left[starts], right[starts], np.add.reduceat(counts[order], starts).astype(np.int64)


def _slice_of(left: np.ndarray, right: np.ndarray, slices: int) -> np.ndarray:
    return (mix(left.astype(np.uint64) ^ mix(right.astype(np.uint64) + np.uint64(1))) % np.uint64(slices)).astype(np.int64)


def _by_slice(left: np.ndarray, right: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """Slices that have pairs, and where these stand."""
    at = _slice_of(left, right, slices)
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(slices + 1)).tolist()
    return [(i, order[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _slices(relation: DataFrame) -> int:
    """As many as keep one within SLICE_PAIRS."""
    pairs = relation.agg(F.coalesce(F.sum("groups"), F.lit(0))).first()[0]
    return max(int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // SLICE_PAIRS))


def _pairs(batch: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    return unpack_numbers(batch.column("lefts")[i].as_py(), True), unpack_numbers(batch.column("rights")[i].as_py())


def _pair_lists(relation: DataFrame, slices: int) -> DataFrame:
    """slice, lefts, rights, counts: packed lists of pairs, added up over the blocks that a task has seen."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def lists() -> pa.RecordBatch:
            left, right, counts = _unique_pairs(*(np.concatenate(c) for c in zip(*held)))
            parts = _by_slice(left, right, slices)
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in parts], pa.int32()), pa.array([pack_numbers(left[p], True) for _, p in parts], pa.binary()),
                 pa.array([pack_numbers(right[p]) for _, p in parts], pa.binary()), pa.array([pack_numbers(counts[p]) for _, p in parts], pa.binary())],
                ["slice", "lefts", "rights", "counts"])

        for batch in batches:
            for i in range(batch.num_rows):
                held.append((*_pairs(batch, i), unpack_numbers(batch.column("counts")[i].as_py())))
                if sum(len(h[0]) for h in held) >= TASK_PAIRS:
                    yield lists()
                    held = []
        if held:
            yield lists()

    return relation.select("lefts", "rights", "counts").mapInArrow(apply, "slice int, lefts binary, rights binary, counts binary")


def _frequent_pairs(relation: DataFrame, support: int) -> DataFrame:
    """Adds up the lists of each slice."""
    def merge(table: pa.Table) -> pa.Table:
        left, right, counts = _unique_pairs(
            np.concatenate([unpack_numbers(v, True) for v in table.column("lefts").to_pylist()]),
            *(np.concatenate([unpack_numbers(v) for v in table.column(c).to_pylist()]) for c in ("rights", "counts")))
        keep = counts >= support
        return pa.table({"left": pa.array(left[keep].astype(np.int64)), "right": pa.array(right[keep].astype(np.int64)), "n": pa.array(counts[keep])})

    return _pair_lists(relation, _slices(relation)).groupBy("slice").applyInArrow(merge, "left long, right long, n long")


def frequent(relation: DataFrame, key: list[str], support: int) -> DataFrame:
    """The groups with ``support`` occurrences or more over all blocks: id, key columns, n."""
    if key == ["names"]:
        groups = relation.select(F.inline(F.arrays_zip("names", F.col("counts").alias("n"))))
        counted = groups.groupBy("names").agg(F.sum("n").alias("n")).filter(F.col("n") >= support)
    else:
        counted = _frequent_pairs(relation, support)
    return staged(counted.withColumn("id", F.monotonically_increasing_id()), "frequent")


class WordIds:
    """Ids of frequent words."""

    def __init__(self, table: pa.Table) -> None:
        self.names, self.ids = table.column("names").combine_chunks(), table.column("id").to_numpy()

    def of(self, names: pa.Array) -> np.ndarray:
        at = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy(zero_copy_only=False)
        return np.where(at >= 0, self.ids[at], -1) if len(self.ids) else np.full(len(names), -1, np.int64)


class PairIds:
    """Ids of frequent pairs of phrases."""

    def __init__(self, members: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        self.members, self.keys, self.ids = members, keys, ids

    @staticmethod
    def parts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the constructor takes: the members of pairs, the pairs by number, and their ids."""
        left, right, ids = (table.column(c).to_numpy().astype(np.int64) for c in ("left", "right", "id"))
        members = np.unique(np.r_[left, right])
        keys = np.searchsorted(members, left) * len(members) + np.searchsorted(members, right)
        order = np.argsort(keys)
        return members, keys[order], ids[order]

    def _place(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.members, values), len(self.members) - 1)
        return at, self.members[at] == values

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.full(len(left), -1, np.int64)
        (a, known_a), (b, known_b) = self._place(left.astype(np.int64)), self._place(right.astype(np.int64))
        keys = a * len(self.members) + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(known_a & known_b & (self.keys[at] == keys), self.ids[at], -1)


def follow(places: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-joins the frequent occurrences with themselves at the next place of the piece.

    Returns places and codes of the longer occurrences, and left, right and count of their groups.
    """
    found = ids[codes]
    keep = found >= 0
    places, found = places[keep], found[keep]
    near = np.flatnonzero(places[1:] == places[:-1] + 1)
    members, own = np.unique(found, return_inverse=True)
    size = max(1, len(members))
    groups, grouped, counts = np.unique(own[near] * size + own[near + 1], return_inverse=True, return_counts=True)
    return places[near], grouped, members[groups // size], members[groups % size], counts


_RELATION = "block long, places binary, codes binary, lefts binary, rights binary, counts binary, groups long"
_KINDS = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("places", "codes", "lefts", "rights", "counts")), ("groups", pa.int64())])


def _longer(batch: pa.RecordBatch | pa.Table, i: int, ids: np.ndarray, last: bool) -> pa.RecordBatch | None:
    places, codes = unpack_numbers(batch.column("places")[i].as_py(), True).view(np.int64), unpack_numbers(batch.column("codes")[i].as_py()).view(np.int64)
    places, codes, left, right, counts = follow(places, codes, ids)
    if not len(counts):
        return None
    # Nothing reads the occurrences of the longest phrases.
    own = [b"", b""] if last else [pack_numbers(places, True), pack_numbers(codes)]
    row = [batch.column("block")[i].as_py(), *own, pack_numbers(left, True), pack_numbers(right), pack_numbers(counts), len(counts)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _KINDS)], schema=_KINDS)


def _pair_answers(relation: DataFrame, known: DataFrame) -> tuple[DataFrame, int]:
    """at (block), slice, ids: packed ids, one higher, of a block's pairs that belong to a slice, in their order, 0 for
    pairs not known; and how many slices there are."""
    slices = _slices(relation)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = _pairs(batch, i)
                parts = _by_slice(left, right, slices)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in parts], pa.int32()), pa.array([batch.column("block")[i].as_py()] * len(parts), pa.int64()),
                     pa.array([pack_numbers(left[p], True) for _, p in parts], pa.binary()), pa.array([pack_numbers(right[p]) for _, p in parts], pa.binary())],
                    ["slice", "block", "lefts", "rights"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _slice_of(batch.column("left").to_numpy(), batch.column("right").to_numpy(), slices)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["slice", *batch.schema.names])

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        ids = PairIds(*PairIds.parts(own))
        found = [pack_numbers(ids.of(*_pairs(asked, i)) + 1) for i in range(asked.num_rows)]
        return pa.table({"at": asked.column("block"), "slice": asked.column("slice"), "ids": pa.array(found, pa.binary())})

    asked = relation.select("block", "lefts", "rights").mapInArrow(ask, "slice int, block long, lefts binary, rights binary")
    dealt = known.select("left", "right", "id").mapInArrow(deal, "slice int, left long, right long, id long")
    return asked.groupBy("slice").cogroup(dealt.groupBy("slice")).applyInArrow(answer, "at long, slice int, ids binary"), slices


def extend(relation: DataFrame, known: DataFrame, key: list[str], last: bool, bound: int = GROUP_BOUND) -> DataFrame:
    """The relation of phrases one word longer, of occurrences whose groups are in ``known``.

    Up to ``bound`` frequent groups travel to the blocks. More words are joined to the words of each
    block, of which no key has more than one row per block; the pairs of each block are looked up in
    slices of the frequent ones. Their ids are sent to the block.
    """
    words = key == ["names"]
    spark, relation = relation.sparkSession, relation.select("block", "places", "codes", *(["names"] if words else ["lefts", "rights", "groups"]))
    size = F.sum(F.length("names")) if words else F.lit(0)
    rows, held = known.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    if rows <= bound and held <= WORD_BYTES:
        table = known.select("id", *key).toArrow()
        shared = spark.sparkContext.broadcast((table,) if words else PairIds.parts(table))

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids = WordIds(*shared.value) if words else PairIds(*shared.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    found = ids.of(batch.column("names")[i].values) if words else ids.of(*_pairs(batch, i))
                    if made := _longer(batch, i, found, last):
                        yield made

        made = _relation(relation.mapInArrow(apply, _RELATION))
        shared.unpersist()
        return made

    slices = 0
    if words:
        named = relation.select("block", F.explode("names").alias("names"))
        answers = named.join(known.select("id", "names"), "names").select(F.col("block").alias("at"), "id", "names")
    else:
        answers, slices = _pair_answers(relation, known)

    def met(block: pa.Table, answers: pa.Table) -> np.ndarray:
        if words:
            return WordIds(answers).of(block.column("names").combine_chunks().values)
        left, right = _pairs(block, 0)
        ids = np.full(len(left), -1, np.int64)
        told = dict(zip(answers.column("slice").to_pylist(), answers.column("ids").to_pylist()))
        for s, part in _by_slice(left, right, slices):
            ids[part] = unpack_numbers(told[s]).view(np.int64) - 1
        return ids

    def meet(block: pa.Table, answers: pa.Table) -> pa.Table:
        made = _longer(block, 0, met(block, answers), last) if block.num_rows else None
        return pa.Table.from_batches([made] if made else [], _KINDS)

    return _relation(relation.groupBy("block").cogroup(answers.groupBy("at")).applyInArrow(meet, _RELATION))


def cohesion(size: Column, n: Column) -> Column:
    """The lowest-scoring cut, as score, k, l, r; of equal scores the one with the smallest k.

    ``first`` and ``last`` hold the counts of the phrase's first and last 1, 2, ... words. Products are
    decimals of 38 digits: exact for up to 10^14 occurrences of a phrase and 10^16 words.
    """
    def cut(k: Column) -> Column:
        left, right = F.get("first", k - 1), F.get("last", size - k - 1)
        over = F.col("a").cast("decimal(14,0)") * F.lit(1000).cast("decimal(4,0)") * n.cast("decimal(16,0)")
        under = left.cast("decimal(14,0)") * right.cast("decimal(14,0)")
        return F.struct(F.call_function("div", over, under).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut))


def phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, best: int | None = BEST, bound: int = GROUP_BOUND,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words.

    ``docs`` has text and lang; all else is ignored. NULL text counts as empty, NULL lang as ``und``.
    A phrase that stands in a longer candidate which occurs as often is left out. Equal scores are
    ordered by occurrences, then by the phrase's bytes; repeated rows count as often as they stand
    there. Words are bytes, so texts that are not UTF-8 do no harm. An empty table, or one without a
    candidate, gives an empty result; ``best`` None gives all candidates.
    """
    bound_batches(docs.sparkSession)
    relation, key = occurrences(docs, block_bytes), ["names"]
    totals = staged(relation.select(F.inline(F.arrays_zip("langs", "totals"))).groupBy(F.col("langs").cast("string").alias("lang"))
                    .agg(F.sum("totals").alias("total")), "totals")
    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        found = frequent(relation, key, support)
        if k == 1:
            word, lang = (F.substring_index(F.col("names").cast("string"), " ", 1),
                          F.expr("substring(cast(names as string), instr(cast(names as string), ' ') + 1)"))
            level = found.select("id", lang.alias("lang"), F.array(word).alias("words"), F.array("n").alias("first"), F.array("n").alias("last"),
                                 F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"), F.col("n").alias("a"))
        else:
            below = levels[-1]
            heads = below.select(F.col("id").alias("left"), "lang", F.col("words").alias("_head"), F.col("first").alias("_first"))
            tails = below.select(F.col("id").alias("right"), F.element_at("words", -1).alias("_tail"), F.col("last").alias("_last"))
            level = lookup_join(lookup_join(found, heads, ["left"], limit=LOOKUP_BYTES), tails, ["right"], limit=LOOKUP_BYTES).select(
                "id", "lang", F.concat("_head", F.array("_tail")).alias("words"), F.concat("_first", F.array("n")).alias("first"),
                F.concat("_last", F.array("n")).alias("last"), "left", "right", F.col("n").alias("a"))
        levels.append(staged(level, "phrases"))
        if k < longest:
            relation = extend(relation, found, key, k + 1 == longest, bound)
            key = ["left", "right"]
    kept = []
    for k, level in enumerate(levels[1:], 1):
        if k + 1 < len(levels):
            # What stands in any longer candidate of equal count stands in one that is a word longer.
            above = levels[k + 1]
            inside = above.select(F.col("left").alias("id"), "a").unionByName(above.select(F.col("right").alias("id"), "a"))
            level = level.join(inside, ["id", "a"], "left_anti")
        kept.append(level.select("lang", "words", "first", "last", "a"))
    whole = lookup_join(reduce(DataFrame.unionByName, kept), totals, ["lang"])
    scored = whole.withColumn("cut", cohesion(F.size("words"), F.col("total"))).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"),
        F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    ranked = ranked if best is None else ranked.filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
