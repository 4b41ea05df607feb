"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide.

Every partition builds a counting quotient filter of its texts' 64-bit fingerprints: the high
bits (the quotient) name a block, the remaining bits are kept sorted inside the block with
counters. Filters merge without loss by merging sorted remainders block by block, so a text that
fills a third of the table is one counter per partition. Only texts whose fingerprint has a count
above one go on to be compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import signed, single_spaced, text_or_empty

#: Quotient bits. A block holds 1/4096 of all fingerprints: about 80 MB for 3e10 documents.
BLOCK_BITS = 12
#: 64-bit words of the routing bitmap; its broadcast never exceeds this many rows.
ROUTE_WORDS = 1 << 18
_FILTER = "block int, remainders binary, counters binary"


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, normal (single-spaced text), fp."""
    return (docs.select("doc_id", single_spaced(text_or_empty()).alias("normal"))
            .withColumn("fp", F.xxhash64("normal")))


def quotient_filters(prints: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One counting quotient filter per partition, a row per non-empty block."""
    rest = np.uint64(64 - block_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy() for b in batches]
        if not found:
            return
        keys, counts = np.unique(np.concatenate(found).view(np.uint64), return_counts=True)
        blocks, starts = np.unique(keys >> rest, return_index=True)
        remainders = keys & np.uint64((1 << int(rest)) - 1)
        cuts = [*starts.tolist(), len(keys)]
        yield pa.RecordBatch.from_arrays([
            pa.array(blocks.astype(np.int32)),
            pa.array([remainders[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], ["block", "remainders", "counters"])

    return prints.select("fp").mapInArrow(build, _FILTER)


def repeated(filters: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Merges filters block by block and returns fingerprints counted more than once: fp, copies."""
    rest = np.uint64(64 - block_bits)

    def merged(block: int, parts: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(r, np.uint64) for r, _ in parts])
        counts = np.concatenate([np.frombuffer(c, np.int64) for _, c in parts])
        order = np.argsort(keys, kind="stable")  # merges the sorted runs
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        totals = np.add.reduceat(counts, starts)
        many = totals > 1
        fps = keys[starts][many] | (np.uint64(block) << rest)
        return pa.RecordBatch.from_arrays([pa.array(signed(fps)), pa.array(totals[many])], ["fp", "copies"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            for block, r, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if block != current and parts:
                    yield merged(current, parts)
                    parts = []
                current = block
                parts.append((r, c))
        if parts:
            yield merged(current, parts)

    return (filters.repartition("block").sortWithinPartitions("block")
            .mapInArrow(merge, "fp long, copies long"))


def routed(prints: DataFrame, wanted: DataFrame, words: int = ROUTE_WORDS) -> DataFrame:
    """Rows whose fingerprint may be among ``wanted``: a bitmap of fixed size is broadcast.

    Lets every wanted row pass; of the others, a share that the later byte comparison removes.
    """
    slot = F.pmod(F.shiftrightunsigned("fp", 6), F.lit(words)).cast("int")
    bit = F.expr("shiftleft(1L, cast(fp & 63 as int))")
    bitmap = wanted.groupBy(slot.alias("_slot")).agg(F.bit_or(bit).alias("_bits"))
    return prints.join(F.broadcast(bitmap), (slot == F.col("_slot")) & (bit.bitwiseAND(F.col("_bits")) != 0),
                       "left_semi")


def duplicate_groups(docs: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Groups of two or more equal texts: fp, text_sha256, keep_id, group_size.

    Copies of a text collapse inside each map task before the shuffle, so a group of any size
    costs one row per task.
    """
    prints = fingerprinted(docs)
    wanted = repeated(quotient_filters(prints, block_bits), block_bits)
    return (routed(prints, wanted).groupBy("fp", "normal")
            .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter("group_size > 1")
            .select("fp", F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their single-spaced forms are. NULL counts as empty; all empty texts are
    one group. The smallest doc_id stays; NULL ids lose to any id, and rows that share the staying
    id (repeated rows) are all marked kept. An empty table gives an empty result. Other columns of
    ``docs`` are ignored.
    """
    groups = duplicate_groups(docs, block_bits).withColumnsRenamed({"fp": "_fp", "text_sha256": "_sha"})
    rows = fingerprinted(docs).select("doc_id", "fp", F.sha2("normal", 256).alias("text_sha256"))
    return (rows.join(groups, (rows.fp == F.col("_fp")) & (rows.text_sha256 == F.col("_sha")), "left")
            .select("doc_id",
                    F.when(F.col("_fp").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (F.col("_fp").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    "text_sha256"))
