"""JSON stored as variants, with an index of its paths and values.

Text is parsed once, when a table is written. The index has one row per node of a document: its path,
its kind and, for scalars, its value; it is sorted by these, so a search for a value or a range reads
the row groups that hold it. A search by containment takes the rarest of the asked values from the
index and tests the whole pattern on the documents that hold it.
"""

from __future__ import annotations

import decimal
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.functions.skew import lookup_join, settle

#: Longest string that the index holds itself; of longer ones it has the start and a digest.
WORD = 64
#: Rows of a folder aimed at, and most folders.
FOLDER_ROWS, MOST_FOLDERS = 100_000, 4096
#: A search that would open more than this share of the documents scans them instead.
SCAN_SHARE = 0.1
#: Most found rows whose folders are named to the scan.
NAMED_ROWS = 50_000
_OWN = ("_row", "_folder")


def kind_of(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``boolean``, ``null`` (JSON null) or ``number``; NULL where there is no value."""
    shape = F.schema_of_variant(value)
    return (F.when(F.startswith(shape, F.lit("OBJECT")), "object").when(F.startswith(shape, F.lit("ARRAY")), "array")
            .when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").when(shape == "VOID", "null")
            .when(shape.isNotNull(), "number"))


def _short(text: Column) -> Column:
    return F.when(F.length(text) <= WORD, text).otherwise(F.concat(F.left(text, F.lit(WORD)), F.sha2(text, 256)))


def step(key: str) -> str:
    """One member access of a path."""
    if not key or '"' in key or "'" in key:
        raise ValueError(f"a key that is empty or has quotes cannot be asked for: {key!r}")
    return f'["{key}"]'


def _equal(value: Column, wanted: str | bool | float | decimal.Decimal | None) -> Column:
    """Whether a variant is this scalar. Numbers are equal as doubles and, where they fit, in nine decimals."""
    if wanted is None:
        return kind_of(value) == "null"
    if isinstance(wanted, bool):
        return (kind_of(value) == "boolean") & (F.try_variant_get(value, "$", "boolean") == F.lit(wanted))
    if isinstance(wanted, str):
        return (kind_of(value) == "string") & (F.try_variant_get(value, "$", "string") == F.lit(wanted))
    if not math.isfinite(wanted):
        raise ValueError("JSON has no such number")
    same = (kind_of(value) == "number") & (F.try_variant_get(value, "$", "double") == F.lit(float(wanted)))
    if abs(wanted) < 10 ** 28:
        exact = F.lit(str(wanted)).cast("decimal(38,9)")
        same = same & F.coalesce(F.try_variant_get(value, "$", "decimal(38,9)") == exact, F.lit(False))
    return same


def contains(value: Column, pattern) -> Column:
    """Whether a variant contains ``pattern``, a Python value as ``json.loads`` gives it.

    An object contains the pattern's members, each containing the member's pattern; an array has for
    every element of the pattern one that contains it, in any order. False where there is no value.
    """
    if isinstance(pattern, dict):
        tests = [contains(F.try_variant_get(value, "$" + step(k), "variant"), p) for k, p in pattern.items()]
        found = reduce(lambda a, b: a & b, tests, kind_of(value) == "object")
    elif isinstance(pattern, list):
        # One look at the elements per element of the pattern.
        elements = F.try_variant_get(value, "$", "array<variant>")
        tests = [F.exists(elements, _holding(p)) for p in pattern]
        found = reduce(lambda a, b: a & b, tests, kind_of(value) == "array")
    else:
        found = _equal(value, pattern)
    return F.coalesce(found, F.lit(False))


def _holding(pattern) -> Callable[[Column], Column]:
    return lambda element: contains(element, pattern)


def _leaves(pattern, path: str = "$") -> Iterator[Column]:
    """Index conditions, each of which a document that contains ``pattern`` meets."""
    if isinstance(pattern, dict) and pattern:
        for k, p in pattern.items():
            yield from _leaves(p, path + step(k))
    elif isinstance(pattern, list) and pattern:
        for p in pattern:
            yield from _leaves(p, path + "[]")
    else:
        at = F.col("path") == path
        if isinstance(pattern, (dict, list)):
            yield at & (F.col("kind") == ("object" if isinstance(pattern, dict) else "array"))
        elif pattern is None:
            yield at & (F.col("kind") == "null")
        elif isinstance(pattern, bool):
            yield at & (F.col("kind") == "boolean") & (F.col("word") == str(pattern).lower())
        elif isinstance(pattern, str):
            yield at & (F.col("kind") == "string") & (F.col("word") == _short(F.lit(pattern)))
        else:
            yield at & (F.col("kind") == "number") & (F.col("number") == F.lit(float(pattern)))


@dataclass(frozen=True)
class VariantStore:
    """A table below ``root`` whose ``column`` is a variant, and the index of that column."""

    spark: SparkSession
    root: str
    column: str

    @classmethod
    def write(cls, df: DataFrame, column: str, root: str, folders: int | None = None) -> VariantStore:
        """Parse ``column`` and write the table and its index.

        Text that is no JSON, like NULL, is stored as NULL: it has no paths and contains nothing; see
        :meth:`unreadable`. Repeated rows stay apart. Nothing is required of the other columns but
        that they are not called ``_row``, ``_folder`` or ``_unread``.
        """
        clash = [c for c in (*_OWN, "_unread") if c in df.columns]
        if clash:
            raise ValueError(f"columns {clash} are used here")
        spark = df.sparkSession
        parsed = df.withColumn("_unread", F.col(column)).withColumn(column, F.try_parse_json("_unread"))
        parsed = parsed.withColumn("_unread", F.when(F.col(column).isNull(), F.col("_unread")))
        # Numbered in a written table, so that a number stays with its row whatever is run again.
        parsed.withColumn("_row", F.monotonically_increasing_id()).write.parquet(f"{root}/parsed")
        numbered = spark.read.parquet(f"{root}/parsed")
        if folders is None:
            folders = max(1, min(MOST_FOLDERS, -(-numbered.count() // FOLDER_ROWS)))
        (numbered.withColumn("_folder", F.pmod(F.xxhash64("_row"), F.lit(folders)).cast("int"))
         .repartitionByRange("_folder", "_row").sortWithinPartitions("_folder", "_row").write.partitionBy("_folder").parquet(f"{root}/rows"))
        layout = StructType([*numbered.schema.fields, StructField("_folder", IntegerType())]).json()
        spark.createDataFrame([(column, folders, layout)], "column string, folders int, layout string").coalesce(1).write.parquet(f"{root}/shape")
        store = cls(spark, root, column)
        store._write_index(numbered)
        return store

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> VariantStore:
        return cls(spark, root, spark.read.parquet(f"{root}/shape").first()["column"])

    def _write_index(self, numbered: DataFrame) -> None:
        """Level by level: members and elements of one level's containers are the next level's nodes."""
        nodes, written = numbered.select("_row", F.lit("$").alias("path"), F.col(self.column).alias("value")).filter("value IS NOT NULL"), []
        while True:
            kind = F.col("kind")
            text = F.try_variant_get("value", "$", "string")
            path = f"{self.root}/levels/{len(written)}"
            (nodes.withColumn("kind", kind_of(F.col("value")))
             .select("_row", "path", "kind", F.when(kind.isin("string", "boolean"), _short(text)).alias("word"),
                     F.when(kind == "number", F.try_variant_get("value", "$", "double")).alias("number"),
                     F.when(kind.isin("object", "array"), F.col("value")).alias("value")).write.parquet(path))
            written.append(path)
            inner = self.spark.read.parquet(path).filter(F.col("kind").isin("object", "array"))
            if inner.isEmpty():
                break
            # Quotes and backslashes in keys are doubled up with a backslash, so that paths stay apart.
            escaped = F.regexp_replace("key", r'(["\\])', r"\\$1")
            name = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit('["'), escaped, F.lit('"]')))
            opened = inner.select("_row", "path", F.col("value").alias("_value")).lateralJoin(self.spark.tvf.variant_explode(F.col("_value").outer()))
            nodes = opened.select("_row", F.concat("path", name).alias("path"), "value")
        place = ["path", "kind", "word", "number", "_row"]
        (self.spark.read.parquet(*written).select(*place).repartitionByRange(*place).sortWithinPartitions(*place)
         .write.parquet(f"{self.root}/index"))

    @property
    def index(self) -> DataFrame:
        """path, kind, word, number, _row: a row per node."""
        return self.spark.read.parquet(f"{self.root}/index")

    def _shape(self):
        return self.spark.read.parquet(f"{self.root}/shape").first()

    @property
    def _all(self) -> DataFrame:
        layout = StructType.fromJson(json.loads(self._shape()["layout"]))
        return self.spark.read.schema(layout).parquet(f"{self.root}/rows")

    @property
    def rows(self) -> DataFrame:
        """The table, its JSON column as variant."""
        return self._all.drop("_unread", *_OWN)

    def unreadable(self) -> DataFrame:
        """Rows whose text is no JSON, with that text."""
        found = self._all.filter(F.col("_unread").isNotNull())
        return found.withColumn(self.column, F.col("_unread")).drop("_unread", *_OWN)

    def paths(self) -> DataFrame:
        """path, kind, n_rows, n_nodes: which paths there are, in how many rows and how often."""
        # Counted per row first: a path that every row has is added up from partial sums.
        each = self.index.groupBy("path", "kind", "_row").agg(F.count(F.lit(1)).alias("n"))
        return each.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_nodes"))

    def find(self, pattern) -> DataFrame:
        """Rows whose JSON contains ``pattern`` (see :func:`contains`)."""
        leaves = list(_leaves(pattern))
        counts = self.index.filter(reduce(lambda a, b: a | b, leaves)).agg(*[F.count_if(leaf) for leaf in leaves]).first()
        rarest = min(range(len(leaves)), key=lambda i: counts[i])
        return self._those(leaves[rarest], counts[rarest], contains(F.col(self.column), pattern))

    def between(self, keys: Sequence[str], low: float, high: float = math.inf) -> DataFrame:
        """Rows whose member at ``keys`` is a number from ``low`` to ``high``, both included, compared as doubles."""
        path = "$" + "".join(step(k) for k in keys)
        held = (F.col("path") == path) & (F.col("kind") == "number") & F.col("number").between(F.lit(float(low)), F.lit(float(high)))
        member = F.try_variant_get(self.column, path, "variant")
        test = (kind_of(member) == "number") & F.try_variant_get(self.column, path, "double").between(F.lit(float(low)), F.lit(float(high)))
        return self._those(held, self.index.filter(held).count(), test)

    def _those(self, held: Column, n: int, test: Column) -> DataFrame:
        """Rows that pass ``test``, all of which the index lists under ``held``, with ``n`` entries there."""
        if n > SCAN_SHARE * self._all.count():
            return self.rows.filter(test)
        found = self.index.filter(held).select("_row").distinct()
        opened = self._all
        if n <= NAMED_ROWS:
            found = settle(found, NAMED_ROWS)
            folders = self._shape()["folders"]
            named = found.select(F.pmod(F.xxhash64("_row"), F.lit(folders)).cast("int").alias("_folder")).distinct()
            opened = opened.filter(F.col("_folder").isin([r[0] for r in named.collect()]))
        return lookup_join(opened, found, ["_row"], "left_semi").filter(test).drop("_unread", *_OWN)
