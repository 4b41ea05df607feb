"""Katz backoff of order two: Good-Turing discounts, exactly normalised backoff weights.

Documents are packed into blocks. Every block sends its distinct n-grams, as sorted 64-bit hashes
with training counts, to slices of the hash range; a slice adds them up, stores its part of the
count table and answers each block with the totals. Each distinct bigram has one owning block,
which adds it to the sums of its context; the context's sums give its backoff weight. A token's
probability is the discounted bigram, or else the weight of its context times that of the word,
which in turn is the discounted unigram or the mass kept for unknown words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import blocks, pack_numbers, unpack, unpack_numbers
from millrace.llm.staging import bound_batches, staged
from millrace.llm.words import LOWER, hash_words, mix, signed

#: Counts up to this are discounted by Good-Turing; higher ones lose REST occurrences, so that every
#: context keeps some mass for words it has not been seen with.
CUTOFF, REST = 5, 0.05
#: Text of one block: larger ones repeat fewer n-grams, smaller ones take less memory.
BLOCK_BYTES = 3 << 20
#: N-grams of a slice's lists that are sorted at a time, on average.
STEP = 1 << 18
_BEGIN, _END = np.uint64(0x5EED0000BE91), np.uint64(0x5EED00000E4D)
_ZERO = np.uint64(0)


@dataclass(frozen=True)
class Level:
    """Counts of counts of one order, up to CUTOFF + 1; occurrences and distinct n-grams."""

    counts: tuple[int, ...]
    tokens: int
    distinct: int

    def discounts(self) -> np.ndarray:
        """Factor of each count; index 0 is unused, the last stands for higher counts (as lost occurrences).

        Where Good-Turing gives no factor between 0 and 1, half an occurrence is taken off.
        """
        out = np.array([1.0] + [1 - 0.5 / r for r in range(1, CUTOFF + 1)])
        n = (0, *self.counts)
        if n[1] and n[CUTOFF + 1]:
            common = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
            for r in range(1, CUTOFF + 1):
                if n[r] and common < 1:
                    d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
                    if 0 < d < 1:
                        out[r] = d
        return out

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        """Counts less what is held back; 0 for unseen ones."""
        low = np.minimum(counts, CUTOFF)
        return np.where(counts > CUTOFF, counts - REST, counts * self.discounts()[low])

    def unknown(self) -> float:
        """Share of the occurrences that is held back, for n-grams never seen."""
        if not self.tokens:
            return 1.0
        held = np.arange(1, CUTOFF + 1) - self.discounted(np.arange(1, CUTOFF + 1))
        high = self.distinct - sum(self.counts[:CUTOFF])
        return float((held @ np.array(self.counts[:CUTOFF]) + REST * high) / self.tokens)


@dataclass
class Grams:
    """Tokens of a block: hash of each, of its context, and of both; where documents end."""

    tokens: np.ndarray
    contexts: np.ndarray
    first: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Grams:
        split = [t.translate(LOWER).split() for t in texts]
        ends = np.cumsum(np.fromiter((len(w) + 1 for w in split), np.int64, len(split)))
        last = np.zeros(int(ends[-1]), bool)
        last[ends - 1] = True
        tokens = np.full(len(last), _END)
        tokens[~last] = hash_words([w for words in split for w in words])
        first = np.r_[True, last[:-1]]
        contexts = np.where(first, _BEGIN, np.r_[_ZERO, tokens[:-1]])
        return cls(tokens, contexts, first, ends)

    def keys(self, level: int) -> np.ndarray:
        return mix(self.tokens) if level == 1 else mix(self.tokens ^ mix(self.contexts + np.uint64(1)))


def slice_cuts(keys: np.ndarray, slices: int) -> list[int]:
    """Where sorted hashes pass from one slice of the hash range to the next."""
    edges = np.array([(i << 64) // slices for i in range(1, slices)], np.uint64)
    return [0, *np.searchsorted(keys, edges).tolist(), len(keys)]


def count_lists(packed: DataFrame, slices: int) -> DataFrame:
    """slice, level, block, keys, counts: the distinct n-grams of each block and their training counts."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, learn, texts in zip(*(batch.column(c).to_pylist() for c in ("block", "learn", "texts"))):
                grams = Grams.of(unpack(texts))
                weight = np.repeat(np.array(learn, float), np.diff(grams.ends, prepend=0))
                for level in (1, 2):
                    keys, place = np.unique(grams.keys(level), return_inverse=True)
                    counts = np.bincount(place, weight, len(keys)).astype(np.uint64)
                    cuts = slice_cuts(keys, slices)
                    parts = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i for i, _, _ in parts], pa.int32()), pa.array([level] * len(parts), pa.int32()),
                         pa.array([block] * len(parts), pa.binary()),
                         pa.array([pack_numbers(keys[a:b], True) for _, a, b in parts], pa.binary()),
                         pa.array([pack_numbers(counts[a:b]) for _, a, b in parts], pa.binary())],
                        ["slice", "level", "block", "keys", "counts"])

    return packed.mapInArrow(apply, "slice int, level int, block binary, keys binary, counts binary")


_MERGED = "kind string, slice int, level int, block binary, keys binary, counts binary, owned binary, stats array<long>"


def add_up(lists: DataFrame) -> DataFrame:
    """Merges a slice's lists. Kind ``table``: its part of the count table, with counts of counts;
    kind ``answer``: for each block the totals of its n-grams, and which of them it owns."""
    def merge(table: pa.Table) -> pa.Table:
        where, level = table.column("slice")[0].as_py(), table.column("level")[0].as_py()
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "keys", "counts"))))
        names, lists, values = ([r[0] for r in rows], [unpack_numbers(k, True) for _, k, _ in rows], [unpack_numbers(c) for _, _, c in rows])
        del rows
        low, high = min(int(x[0]) for x in lists), max(int(x[-1]) for x in lists)
        steps = 1 + sum(map(len, lists)) // STEP
        edges = np.array([low + (high - low) * i // steps for i in range(1, steps)], np.uint64)
        cuts = [[0, *np.searchsorted(x, edges).tolist(), len(x)] for x in lists]
        answers, owners = [[] for _ in lists], [[] for _ in lists]
        stored, stored_counts = [], []
        for i in range(steps):  # hash range by hash range, so that the sort takes little memory
            spans = [slice(*c[i:i + 2]) for c in cuts]
            keys, first, place = np.unique(np.concatenate([x[s] for x, s in zip(lists, spans)]), return_index=True, return_inverse=True)
            totals = np.bincount(place, np.concatenate([v[s] for v, s in zip(values, spans)]), len(keys)).astype(np.int64)
            owned = np.zeros(len(place), bool)
            owned[first] = True
            stored.append(keys[totals > 0])
            stored_counts.append(totals[totals > 0])
            at = 0
            for j, s in enumerate(spans):
                here = slice(at, at := at + s.stop - s.start)
                answers[j].append(totals[place[here]].astype(np.uint32 if totals.max(initial=0) < 1 << 32 else np.int64))
                owners[j].append(owned[here])
        del lists, values
        seen = np.concatenate(stored_counts)
        stats = [*np.bincount(np.minimum(seen, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].tolist(), int(seen.sum()), len(seen)]
        out = [("table", where, level, None, pack_numbers(np.concatenate(stored), True), pack_numbers(seen), None, stats)]
        last = None
        for block, totals, owned in zip(names, answers, owners):
            if block != last:  # equal blocks count each, and share one answer
                out.append(("answer", where, level, block, None, pack_numbers(np.concatenate(totals)), np.packbits(np.concatenate(owned)).tobytes(), None))
            last = block
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        ["kind", "slice", "level", "block", "keys", "counts", "owned", "stats"])

    return lists.groupBy("slice", "level").applyInArrow(merge, _MERGED)


def levels(table: DataFrame) -> tuple[Level, Level]:
    """Counts of counts of both orders, added up over the slices."""
    width = CUTOFF + 3
    sums = {r[0]: r[1:] for r in table.groupBy("level").agg(*[F.sum(F.col("stats")[i]) for i in range(width)]).collect()}
    return tuple(Level(tuple(s[:CUTOFF + 1]), s[-2], s[-1]) for s in (sums.get(n, (0,) * width) for n in (1, 2)))


def katz_scores(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Scores every text with a model learnt from the rows whose ``learn`` is true.

    ``docs`` has doc_id, text and learn. One row per row: doc_id, learn, n_tokens, n_known,
    train_tokens, base_score (add-one unigrams), score (log10 probability). Words are lower-cased
    A-Z; every text has an end token, so NULL and empty texts have one token. All words that
    training has not seen share one probability. A NULL ``learn`` counts as false. With nothing to
    learn from, every probability is 1. N-grams are told apart by 64-bit hashes. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.coalesce("learn", F.lit(False)).alias("learn"))
    packed = blocks(docs, ("doc_id", "learn"), BLOCK_BYTES)
    merged = staged(add_up(count_lists(packed, slices)), "katz-counts", "kind")
    one, two = levels(merged.filter("kind = 'table'"))
    texts = docs.filter("learn").count()
    answers = merged.filter("kind = 'answer'").select("block", "slice", "level", "counts", "owned")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(zip(*(right.column(c).to_pylist() for c in ("level", "slice", "counts", "owned"))), key=lambda r: r[:2])
        totals = {n: np.concatenate([unpack_numbers(c) for level, _, c, _ in rows if level == n]).astype(np.int64) for n in (1, 2)}
        owned = np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(unpack_numbers(c))).astype(bool)
                                for level, _, c, o in rows if level == 2])
        out = []
        for copy, (block, ids, learn, packed_texts) in enumerate(zip(*(left.column(c).to_pylist() for c in ("block", "doc_id", "learn", "texts")))):
            grams = Grams.of(unpack(packed_texts))
            _, place1 = np.unique(grams.keys(1), return_inverse=True)
            _, head, place2 = np.unique(grams.keys(2), return_index=True, return_inverse=True)
            c1, c2 = totals[1][place1], totals[2][place2]
            before = np.where(grams.first, texts, np.r_[0, c1[:-1]])
            p1 = np.where(c1 > 0, one.discounted(c1) / max(1, one.tokens), one.unknown())
            p = np.where(c2 > 0, two.discounted(c2) / np.maximum(before, 1), p1)
            base = np.log10((c1 + 1) / (one.tokens + one.distinct + 1))
            starts = np.r_[0, grams.ends[:-1]]
            known, based, direct = (np.add.reduceat(x, starts) for x in ((c1 > 0).astype(np.int64), base, np.log10(p)))
            waits = (c2 == 0) & (before > 0)  # these are multiplied by their context's weight
            contexts = signed(grams.contexts)
            opened = [contexts[a:b][waits[a:b]] for a, b in zip(starts.tolist(), grams.ends.tolist())]
            n = len(ids)
            out.append(pa.table([
                pa.array(["doc"] * n), pa.array([f"{block.hex()}-{copy}-{i}" for i in range(n)]), pa.array(ids, left.schema.field("doc_id").type.value_type),
                pa.array(learn), pa.array(grams.ends - starts), pa.array(known), pa.array(based), pa.array(direct),
                pa.array(opened, pa.list_(pa.int64())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())], _LOOKED))
            mine = head[owned & (totals[2] > 0)]
            if copy or not len(mine):
                continue  # an equal block has been added to the contexts
            names, one_of, spot = np.unique(contexts[mine], return_index=True, return_inverse=True)
            held = np.bincount(spot, c2[mine] - two.discounted(c2[mine]), len(names))
            low = np.bincount(spot, p1[mine], len(names))
            m = len(names)
            out.append(pa.table([pa.array(["context"] * m, pa.string()), pa.nulls(m, pa.string()), pa.nulls(m, left.schema.field("doc_id").type.value_type),
                                 pa.nulls(m, pa.bool_()), *(pa.nulls(m, pa.int64()) for _ in range(2)), *(pa.nulls(m, pa.float64()) for _ in range(2)),
                                 pa.nulls(m, pa.list_(pa.int64())), pa.array(names), pa.array(held / before[mine][one_of]), pa.array(low)], _LOOKED))
        return pa.concat_tables(out)

    looked = staged(packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(look_up, (
        f"kind string, row string, doc_id {kind}, learn boolean, n_tokens long, n_known long, base_score double, "
        "direct double, opened array<long>, context long, held double, low double")), "katz-scores", "kind")
    rows = looked.filter("kind = 'doc'")
    # What a context holds back, over what the lower order gives to the words not seen after it.
    # Written, so that the join below stands alone and a busy context can be split over tasks.
    weights = staged(looked.filter("kind = 'context'").groupBy("context").agg(F.sum("held").alias("held"), F.sum("low").alias("low"))
                     .select("context", F.log10(F.col("held") / (1 - F.col("low"))).alias("weight")), "katz-weights")
    backed = (rows.select("row", F.explode("opened").alias("context")).groupBy("context", "row").agg(F.count(F.lit(1)).alias("times"))
              .join(weights, "context").groupBy(F.col("row").alias("_row")).agg(F.sum(F.col("times") * F.col("weight")).alias("backed")))
    return (rows.join(backed, F.col("row") == F.col("_row"), "left")
            .select("doc_id", "learn", "n_tokens", "n_known", F.lit(one.tokens).cast("long").alias("train_tokens"), "base_score",
                    (F.col("direct") + F.coalesce("backed", F.lit(0.0))).alias("score")))


_LOOKED = ["kind", "row", "doc_id", "learn", "n_tokens", "n_known", "base_score", "direct", "opened", "context", "held", "low"]
