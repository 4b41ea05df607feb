"""Comparing two stored tables by checksums, opening only what differs.

A table is written in parts (folders) by a hash of its key, and a part in leaves. Every leaf and every
part has a checksum that does not depend on the order of rows. Two tables of the same shape are
compared from the top: parts whose checksums agree are not looked at again, of the others the leaves
are compared, and only rows of leaves that differ are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.skew import lookup_join

#: Most parts, rows of a part, and rows of a leaf aimed at.
MOST_PARTS, PART_ROWS, LEAF_ROWS = 4096, 5_000_000, 2_000
_SHAPE = "keys array<string>, parts int, leaves int, version string, columns string"
_PLACE, _OWN = ["_part", "_leaf"], ("_part", "_leaf", "_sum", "_xor", "_n")


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row; where its NULLs are counts too."""
    names = sorted(columns)
    return F.xxhash64(F.lit(seed), *names, *[F.col(c).isNull() for c in names])


def _checksum(columns: Sequence[str]) -> list[Column]:
    """Rows, the exact sum of one hash and the exclusive or of another."""
    return [F.count(F.lit(1)).alias("_n"), F.sum(row_hash(columns, 1).cast("decimal(20,0)")).alias("_sum"),
            F.bit_xor(row_hash(columns, 2)).alias("_xor")]


@dataclass(frozen=True)
class ChecksumTree:
    """A table below ``root`` in ``parts`` parts of ``leaves`` leaves, its checksums, and the version it holds."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    parts: int
    leaves: int
    version: str

    @classmethod
    def write(cls, df: DataFrame, keys: Sequence[str], root: str, version: str = "", like: ChecksumTree | None = None,
              parts: int | None = None, leaves: int | None = None) -> ChecksumTree:
        """Write ``df`` with its checksums. Tables that are to be compared need one shape: pass the
        first one as ``like``. Without it the shape follows from the number of rows."""
        clash = [c for c in _OWN if c in df.columns]
        if not keys or clash:
            raise ValueError(f"columns {clash} are used here" if clash else "a comparison needs key columns")
        spark = df.sparkSession
        if like is not None:
            parts, leaves = like.parts, like.leaves
        if parts is None or leaves is None:
            n = df.count()
            parts = parts or max(64, min(MOST_PARTS, -(-n // PART_ROWS)))
            leaves = leaves or max(1, -(-n // (parts * LEAF_ROWS)))
        place = F.pmod(F.xxhash64(F.lit(3), F.struct(*keys)), F.lit(parts * leaves))
        placed = df.withColumns({"_part": F.floor(place / F.lit(leaves)).cast("int"), "_leaf": F.pmod(place, F.lit(leaves)).cast("int")})
        # By range, so that a busy key is dealt to as many tasks as its rows need.
        (placed.repartitionByRange("_part", "_leaf", row_hash(df.columns, 1)).sortWithinPartitions("_part", "_leaf")
         .write.partitionBy("_part").parquet(f"{root}/rows"))
        tree = cls(spark, root, tuple(keys), parts, leaves, version)
        spark.read.schema(placed.schema).parquet(f"{root}/rows").groupBy(*_PLACE).agg(*_checksum(df.columns)).repartition("_part").write.partitionBy("_part").parquet(f"{root}/leaves")
        (tree._leaf_sums().groupBy("_part").agg(F.sum("_n").alias("_n"), F.sum("_sum").cast("decimal(38,0)").alias("_sum"), F.bit_xor("_xor").alias("_xor"))
         .coalesce(1).write.parquet(f"{root}/parts"))
        spark.createDataFrame([(list(keys), parts, leaves, version, df.schema.json())], _SHAPE).coalesce(1).write.parquet(f"{root}/shape")
        return tree

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ChecksumTree:
        keys, parts, leaves, version, _ = spark.read.parquet(f"{root}/shape").first()
        return cls(spark, root, tuple(keys), parts, leaves, version)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _leaf_sums(self) -> DataFrame:
        return self.spark.read.schema("_leaf int, _n long, _sum decimal(30,0), _xor long, _part int").parquet(f"{self.root}/leaves")

    @property
    def columns(self) -> dict[str, str]:
        stored = StructType.fromJson(json.loads(self._read("shape").first()["columns"]))
        return {f.name: f.dataType.simpleString() for f in stored}

    @property
    def rows(self) -> DataFrame:
        """The table itself, with its places."""
        layout = ", ".join(f"`{n}` {k}" for n, k in self.columns.items())
        return self.spark.read.schema(f"{layout}, _leaf int, _part int").parquet(f"{self.root}/rows")

    def part_sums(self) -> dict[int, tuple]:
        """Checksum of every part; there are ``parts`` at most."""
        return {r["_part"]: (r["_n"], r["_sum"], r["_xor"]) for r in self._read("parts").collect()}

    def differing_parts(self, other: ChecksumTree) -> list[int]:
        mine, theirs = self.part_sums(), other.part_sums()
        return sorted(p for p in mine.keys() | theirs.keys() if mine.get(p) != theirs.get(p))

    def differing_leaves(self, other: ChecksumTree) -> DataFrame:
        """Places of the leaves that differ; only leaf checksums of parts that differ are read."""
        parts = self.differing_parts(other)
        a, b = (t._leaf_sums().filter(F.col("_part").isin(parts)).select(*_PLACE, F.struct("_n", "_sum", "_xor").alias(name))
                for t, name in ((self, "_a"), (other, "_b")))
        return a.join(b, _PLACE, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*_PLACE)

    def opened(self, leaves: DataFrame, parts: Sequence[int]) -> DataFrame:
        """The rows of the listed leaves; folders of other parts are not read."""
        return lookup_join(self.rows.filter(F.col("_part").isin(list(parts))), leaves, _PLACE, "left_semi")


def same(a: ChecksumTree, b: ChecksumTree) -> bool:
    """Whether both hold the same rows, as often; no row is read."""
    _check(a, b)
    return not a.differing_parts(b)


def _check(a: ChecksumTree, b: ChecksumTree) -> None:
    if (a.keys, a.parts, a.leaves) != (b.keys, b.parts, b.leaves):
        raise ValueError("the tables have different keys or shapes; write one like the other")
    if a.columns != b.columns:
        names = sorted(n for n in a.columns.keys() | b.columns.keys() if a.columns.get(n) != b.columns.get(n))
        raise ValueError(f"columns differ: {', '.join(names)}")


def differences(a: ChecksumTree, b: ChecksumTree) -> DataFrame:
    """Key columns and ``status`` of every key whose rows differ: ``only_a``, ``only_b`` or ``changed``.

    A NULL key is a key; a key with several rows is equal if both sides have the same rows as often.
    """
    _check(a, b)
    keys, parts = list(a.keys), a.differing_parts(b)
    leaves = a.differing_leaves(b)

    def sums(tree: ChecksumTree, name: str) -> DataFrame:
        return (tree.opened(leaves, parts).groupBy(F.struct(*keys).alias("_key")).agg(*_checksum(list(tree.columns)))
                .select("_key", F.struct("_n", "_sum", "_xor").alias(name)))

    met = sums(a, "_a").join(sums(b, "_b"), "_key", "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    status = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").otherwise("changed")
    return met.select("_key.*", status.alias("status"))
