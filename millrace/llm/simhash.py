"""Near duplicates by SimHash, found through a Gray-order hierarchical index.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bit segments. Each
fingerprint joins one cell per segment; in a cell, fingerprints stand in Gray order, where
neighbours share long bit patterns. Runs of neighbours form nodes that hold the bits all of them
share, runs of nodes form the next level. Two nodes are compared by the bits both have fixed: if
these already differ in more than ``radius`` places, none of the pairs below can be a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import bound_batches, staged
from millrace.llm.words import LOWER, mix, signed, utf8
from millrace.session import shared_dir

RADIUS = 2
SHINGLE = 3
#: Fingerprints in one cell. Fuller cells are split again by the bits they have not used.
CELL_ROWS = 50_000
#: Children of an index node.
FAN = 8
#: Node pairs looked at in one step.
STEP = 1 << 20
_SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    total, set_bits = len(words) - k + 1, np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):  # bounded memory for very long texts
        until = min(total, at + (1 << 16))
        h = np.array([hashed(line[a:b], _SEED) for a, b in
                      zip(starts[at:until].tolist(), ends[at + k - 1:until + k - 1].tolist())], np.uint64)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp: a fingerprint for each row."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in utf8(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed(fps))], ["doc_id", "fp"])

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, fp long")


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in Gray order."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def split_cells(rows: DataFrame, radius: int) -> DataFrame:
    """Puts each row (fp, cell, used) into ``radius + 1`` cells, one per segment of the unused bits."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, cell, used = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "cell", "used"))
            for mask in np.unique(used).tolist():
                here = used == np.uint64(mask)
                free = [b for b in range(64) if not mask >> b & 1]
                for s in range(radius + 1):
                    segment = sum(1 << b for b in free[len(free) * s // (radius + 1):len(free) * (s + 1) // (radius + 1)])
                    own = mix(mix(cell[here] + np.uint64(s + 1)) ^ (fp[here] & np.uint64(segment)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(x)) for x in (fp[here], own, np.full(here.sum(), mask | segment, np.uint64))],
                        ["fp", "cell", "used"])

    return rows.mapInArrow(apply, "fp long, cell long, used long")


def cells(fps: DataFrame, radius: int = RADIUS, limit: int = CELL_ROWS) -> DataFrame:
    """Cells of bounded size, so that every pair within ``radius`` bits shares one: fp, cell."""
    rows = split_cells(fps.select("fp", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("used")), radius)
    done = None
    for _ in range(5):  # 64 bits leave 43, 29, 20, 14, 10 unused at radius 2
        full = rows.groupBy("cell").count().filter(F.col("count") > limit).select("cell")
        if full.isEmpty():
            break
        cool = rows.join(full, "cell", "left_anti").select("fp", "cell")
        done = cool if done is None else done.unionByName(cool)
        rows = staged(split_cells(rows.join(full, "cell", "left_semi").select("fp", "cell", "used"), radius), "cells")
    rows = rows.select("fp", "cell")
    return rows if done is None else done.unionByName(rows)


def linked_pairs(fps: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of one group within ``radius`` bits; input in (group, Gray rank) order."""
    levels = [(fps, ~fps, None, None)]  # bits set in all, bits clear in all, children from, children to
    owner = groups
    while True:
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        if len(first) == len(owner):
            break
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        heads = np.flatnonzero(place % FAN == 0)
        ones, zeros = levels[-1][:2]
        levels.append((np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads),
                       heads, np.r_[heads[1:], len(owner)]))
        owner = owner[heads]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def descend(level: int, a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), STEP):
            x, y = a[at:at + STEP], b[at:at + STEP]
            ones, zeros, start, stop = levels[level]
            apart = (ones[x] & zeros[y]) | (zeros[x] & ones[y])
            near = np.bitwise_count(apart) <= radius
            x, y = x[near], y[near]
            if level == 0:
                other = x != y
                found.append((x[other], y[other]))
                continue
            for lo in range(0, len(x), STEP // FAN ** 2):
                p, q = x[lo:lo + STEP // FAN ** 2], y[lo:lo + STEP // FAN ** 2]
                wide = (stop[p] - start[p]) * (stop[q] - start[q])
                pair = np.repeat(np.arange(len(p)), wide)
                k = np.arange(len(pair)) - np.repeat(np.cumsum(wide) - wide, wide)
                width = (stop[q] - start[q])[pair]
                c, d = start[p][pair] + k // width, start[q][pair] + k % width
                once = c <= d
                descend(level - 1, c[once], d[once])

    roots = np.arange(len(owner))
    descend(len(levels) - 1, roots, roots)
    return (np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])) if found else (roots[:0], roots[:0])


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each position the smallest position that the pairs connect it with."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links(fps: DataFrame, radius: int = RADIUS, limit: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all those within ``radius`` bits.

    In each cell every link is found; what leaves the cell is a spanning forest of them.
    """
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def search(fp: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
            many = np.zeros(len(cell), bool)  # cells of one fingerprint have no pair
            many[1:] |= cell[1:] == cell[:-1]
            many[:-1] |= cell[1:] == cell[:-1]
            fp, cell = fp[many], cell[many]
            label = np.arange(len(fp))
            if len(fp):
                label = _forest(len(fp), *linked_pairs(fp, cell, radius))
            tied = label != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(signed(fp[label[tied]])), pa.array(signed(fp[tied]))], ["a", "b"])

        for batch in batches:
            held.append((batch.column("fp").to_numpy().view(np.uint64), batch.column("cell").to_numpy()))
            if sum(len(x) for x, _ in held) < 2 * limit:
                continue
            fp, cell = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            held = [(fp[last:], cell[last:])]
            if last:
                yield search(fp[:last], cell[:last])
        if held:
            yield search(*(np.concatenate(x) for x in zip(*held)))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = gray_rank(batch.column("fp").to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
            yield batch.append_column("rank", pa.array(signed(rank)))

    return (cells(fps, radius, limit).mapInArrow(ranked, "fp long, cell long, rank long")
            .repartition("cell").sortWithinPartitions("cell", "rank")
            .mapInArrow(apply, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): node, root (its smallest node); roots themselves are left out.

    Alternates large-star and small-star steps until nothing moves. Every round is checkpointed
    to the shared folder.
    """
    shared_dir(edges.sparkSession)
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).filter("node <> root").distinct()
    before = None
    for _ in range(60):
        both = down.unionByName(down.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("low"))
        large = both.join(low, "node").filter("root > node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node")
        down = (small.select(F.col("root").alias("node"), F.col("low").alias("root"))
                .unionByName(small.select("node", F.col("low").alias("root"))).filter("node <> root").distinct().checkpoint())
        now = tuple(down.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root")), F.sum(F.xxhash64("node", "root") % 1_000_003)).first())
        if now == before:
            return down
        before = now
    raise RuntimeError("components did not settle")


def simhash_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, limit: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id reachable over links).

    NULL and empty texts have fingerprint 0 and link like any other. Rows with equal fingerprints
    are one node, however many there are. NULL ids lose to any id. Empty tables give empty results;
    other columns of ``docs`` are ignored.
    """
    prints = staged(fingerprints(docs, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    tied = components(links(nodes.select("fp"), radius, limit))
    rooted = nodes.join(tied.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(first, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The row with the smallest doc_id of each component, with all its columns."""
    found = simhash_components(docs, radius, shingle)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("staying")).distinct()
    # The row travels in a struct, so that none of its columns can clash.
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    return rows.join(stay, F.col("doc_id").eqNullSafe(F.col("staying")), "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])
