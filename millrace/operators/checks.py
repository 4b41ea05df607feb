"""Declared table contracts and verification jobs that return their findings as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.skew import key_set


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableContract:
    """What a table promises. Spark stores the rows; :func:`violations` checks the promises."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    def create(self, spark: SparkSession, location: str | None = None,
               properties: Mapping[str, str] | None = None) -> None:
        """Create the table if it is absent."""
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
            for f in self.schema.fields)
        where = f" LOCATION '{location}'" if location else ""
        extra = ""
        if properties:
            pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
            extra = f" TBLPROPERTIES ({pairs})"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet{where}{extra}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame,
            parent_columns: Sequence[str]) -> DataFrame:
    """Foreign-key values without a parent and how many rows carry them. NULL refers to nothing.

    Children are counted per value first, so a value held by many rows is one row in the join.
    """
    values = child.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).dropna(subset=list(columns))
    known = key_set(parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)]), columns)
    return values.join(known, list(columns), "left_anti")


def violations(df: DataFrame, contract: TableContract, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per rule with the number of violating rows.

    NOT NULL and CHECK rules share one scan. A CHECK that is NULL holds, as in SQL. Key rules
    count the surplus rows.
    """
    rules: list[tuple[str, str, Column]] = []
    required = [*contract.primary_key, *contract.not_null]
    for column in dict.fromkeys(required):
        rules.append(("not_null", column, F.col(column).isNull()))
    for name, text in contract.checks.items():
        rules.append(("check", name, ~F.coalesce(F.expr(text), F.lit(True))))
    parts = []
    if rules:
        counted = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(rules)])
        listed = F.array(*[F.struct(F.lit(kind).alias("rule"), F.lit(name).alias("target"),
                                    F.col(f"_{i}").alias("n_violations"))
                           for i, (kind, name, _) in enumerate(rules)])
        parts.append(counted.select(F.explode(listed).alias("r")).select("r.*"))
    for keys in ([contract.primary_key] if contract.primary_key else []) + list(contract.unique):
        surplus = duplicate_keys(df.dropna(subset=list(keys)), keys)
        parts.append(surplus.agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n_violations"))
                     .select(F.lit("unique").alias("rule"), F.lit(", ".join(keys)).alias("target"), "n_violations"))
    for fk in contract.foreign_keys:
        lost = orphans(df, fk.columns, (parents or {})[fk.parent], fk.parent_columns)
        parts.append(lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_violations"))
                     .select(F.lit("foreign_key").alias("rule"), F.lit(", ".join(fk.columns)).alias("target"),
                             "n_violations"))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(contract.name).alias("table_name"), "rule", "target", "n_violations")


def reconcile_counts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows on both sides, keys missing on either side, keys whose content differs."""
    from millrace.operators.cdc import reconcile_versions
    status = reconcile_versions(source, target, keys)
    return status.agg(
        F.count_if(F.col("a").isNotNull()).alias("n_source"),
        F.count_if(F.col("b").isNotNull()).alias("n_target"),
        F.count_if(F.col("status") == "only_a").alias("n_missing"),
        F.count_if(F.col("status") == "only_b").alias("n_extra"),
        F.count_if(F.col("status") == "changed").alias("n_changed"))


def schema_drift(expected: T.StructType, df: DataFrame) -> DataFrame:
    """Columns added, removed or retyped, with how many rows of ``df`` hold a value there."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = []
    for name in sorted(want.keys() | have.keys()):
        if name not in have:
            found.append((name, "removed", F.lit(0).cast("long")))
        elif name not in want:
            found.append((name, "added", F.count(F.col(name))))
        elif want[name] != have[name]:
            found.append((name, "retyped", F.count(F.col(name))))
    if not found:
        return df.sparkSession.createDataFrame([], "column_name string, drift string, n_rows_affected long")
    counted = df.agg(*[c.alias(f"_{i}") for i, (_, _, c) in enumerate(found)])
    listed = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(kind).alias("drift"),
                                F.col(f"_{i}").alias("n_rows_affected"))
                       for i, (n, kind, _) in enumerate(found)])
    return counted.select(F.explode(listed).alias("d")).select("d.*")


def describe_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalog listing: table, column, position, type, rows and NULLs; one scan per table."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                         *[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
        listed = F.array(*[
            F.struct(F.lit(f.name).alias("column_name"), F.lit(i + 1).cast("long").alias("position"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_{i}")).alias("n_null"))
            for i, f in enumerate(df.schema.fields)])
        parts.append(counted.select(F.lit(name).alias("table_name"), F.explode(listed).alias("c"))
                     .select("table_name", "c.*"))
    return reduce(DataFrame.unionByName, parts)


def checklist(items: Sequence[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """Pass/fail table. Each item is (check, one-row DataFrame, detail, ok)."""
    parts = [df.select(F.lit(name).alias("check_name"), detail.cast("string").alias("detail"),
                       F.coalesce(ok, F.lit(False)).alias("ok")) for name, df, detail, ok in items]
    return reduce(DataFrame.unionByName, parts)


def expected_subset(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that were not found; empty when all were."""
    return key_set(expected, keys).join(key_set(found, keys), list(keys), "left_anti")
