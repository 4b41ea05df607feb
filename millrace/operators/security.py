"""Row policies, effective grants and isolation checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.skew import key_set, lookup_join


def owned_by(df: DataFrame, owner: str, principal: str | Column | None = None,
             bypass: bool = False) -> DataFrame:
    """Rows whose owner is the principal (the session's user by default).

    Rows without an owner are visible to nobody. The filter is a plain predicate on ``owner``,
    so it reaches the scan. Only an explicit ``bypass`` lifts it.
    """
    if bypass:
        return df
    who = F.current_user() if principal is None else principal
    return df.filter(F.col(owner) == (F.lit(who) if not isinstance(who, Column) else who))


def assigned_rows(df: DataFrame, assignments: DataFrame, principal: str, on: Sequence[str],
                  who: str = "principal") -> DataFrame:
    """Rows in a scope (such as a region) that is assigned to the principal."""
    scope = key_set(assignments.filter(F.col(who) == principal), on)
    return lookup_join(df, scope, list(on), "left_semi")


def visible_counts(df: DataFrame, owner: str) -> DataFrame:
    """Rows each principal sees under the owner policy, beside the table's total."""
    total = df.count()
    return (df.filter(F.col(owner).isNotNull()).groupBy(owner)
            .agg(F.count(F.lit(1)).alias("n_visible"))
            .withColumn("n_total", F.lit(total).cast("long")))


def shared_rows(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows two principals both see; empty when they are isolated."""
    return first.join(key_set(second, keys), list(keys), "left_semi")


def effective_access(catalog_grants: DataFrame, table_grants: DataFrame, principal: str = "principal",
                     object_name: str = "object_name") -> DataFrame:
    """Access needs a grant at both levels; the best grant of each level counts, the weaker of the two wins.

    A privilege that is missing or not SELECT, MODIFY or ALL grants nothing.
    """
    names = ["SELECT", "MODIFY", "ALL"]
    level = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("privilege"))

    def best(grants: DataFrame) -> DataFrame:
        return (grants.filter(level > 0).groupBy(principal, object_name).agg(F.max(level).alias("_level")))

    both = best(catalog_grants).unionByName(best(table_grants)).groupBy(principal, object_name).agg(
        F.count(F.lit(1)).alias("_levels"), F.min("_level").alias("_level"))
    return both.filter("_levels = 2").select(
        principal, object_name, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_level").cast("int")).alias("privilege"))
