"""Summaries, searches and log joins over operational tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.skew import BROADCAST_LIMIT, key_set, lookup_join, planned_bytes
from millrace.functions.timing import gap_seconds, micros
from millrace.operators.keyed import asof_join, nearest_rank, top_k


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group, largest first, ties by key."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), *keys))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its NULL and non-NULL counts, from a single scan."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_present"))
                      for c in columns])
    return (counts.select("_rows", F.explode(pairs).alias("p"))
            .select("p.column_name", "p.n_present",
                    (F.col("_rows") - F.col("p.n_present")).alias("n_null")))


def call_summary(calls: DataFrame, tool: str, duration: str, ts: str) -> DataFrame:
    """Audit summary per tool: calls, mean duration (one decimal), last call; busiest first."""
    return (calls.groupBy(tool)
            .agg(F.count(F.lit(1)).alias("n_calls"), F.round(F.avg(duration), 1).alias("avg_ms"),
                 F.max(ts).alias("last_call"))
            .orderBy(F.col("n_calls").desc(), tool))


def success_rate(calls: DataFrame, tool: str, ok: Column) -> DataFrame:
    """Calls, failures and share of successes per tool."""
    return calls.groupBy(tool).agg(
        F.count(F.lit(1)).alias("n_calls"), F.count_if(~ok).alias("n_failed"),
        F.round(F.avg(ok.cast("double")), 4).alias("success_rate"))


def latency_summary(calls: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and nearest-rank p95 per group; rows with a NULL key form a group like any other."""
    means = calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.avg(value), 3).alias("mean"))
    ranks = nearest_rank(calls, keys, value, 0.95).select(*[F.col(k).alias(f"_{k}") for k in keys], "p95")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return means.join(ranks, same, "left").select(*means.columns, "p95")


def daily_rollup(df: DataFrame, ts: str, newest: int = 30, **measures: Column) -> DataFrame:
    """Per-day aggregates of the newest ``newest`` days that have rows, latest first."""
    daily = df.groupBy(F.date_trunc("day", ts).cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in measures.items()])
    return top_k(daily, [F.col("day").desc()], newest)


def time_rollup(events: DataFrame, ts: str, width: str, keys: Sequence[str], value: str) -> DataFrame:
    """Tumbling-window rollup: count, sum and maximum per window and key."""
    return (events.groupBy(F.window(ts, width).alias("_w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias("total"),
                 F.max(value).alias("peak"))
            .select(F.col("_w.start").alias("window_start"), *keys, "n", "total", "peak"))


def resolve_times(parents: DataFrame, outcomes: DataFrame, key: str, opened: str, closed: str) -> DataFrame:
    """Each outcome with the seconds since its parent was opened."""
    opened_at = parents.select(key, opened)
    return lookup_join(outcomes, opened_at, [key]).withColumn(
        "seconds", gap_seconds(opened, closed))


def mean_resolve_time(parents: DataFrame, outcomes: DataFrame, key: str, opened: str, closed: str,
                      category: str) -> DataFrame:
    """Mean seconds and count per category.

    Outcomes are summed per (key, category) before the join, so a key with very many outcomes
    reaches the join as a few rows. Microseconds are summed exactly, as whole seconds and the rest
    of each, since their sums pass 64 bits: two months' gaps do so in some two million rows.
    """
    second = F.lit(1_000_000)

    def parts(ts: str) -> tuple[Column, Column]:
        whole = F.floor(micros(ts) / second)
        return whole, micros(ts) - whole * second

    seconds, rest = parts(closed)
    summed = (outcomes.dropna(subset=[key, closed]).groupBy(key, category)
              .agg(F.count(F.lit(1)).alias("_n"), F.sum(seconds).alias("_seconds"), F.sum(rest).alias("_rest")))
    opened_seconds, opened_rest = parts(opened)
    opened_at = parents.dropna(subset=[opened]).select(key, opened_seconds.alias("_from"), opened_rest.alias("_from_rest"))
    total = (F.sum(F.col("_seconds") - F.col("_n") * F.col("_from")).cast("decimal(20,0)") * second
             + F.sum(F.col("_rest") - F.col("_n") * F.col("_from_rest")))
    return (summed.join(opened_at, key).groupBy(category)
            .agg(F.sum("_n").alias("n"),
                 F.round(total.cast("double") / F.sum("_n") / F.lit(1e6), 1).alias("avg_seconds")))


def entity_search(entities: DataFrame, key: str, name: str, activity: DataFrame, activity_ts: str,
                  text: str, k: int = 50) -> DataFrame:
    """Entities whose name starts with ``text`` or whose initials equal it, most recently
    active first."""
    low = F.lower(F.col(name))
    initials = F.array_join(F.transform(F.split(low, "[^\\p{L}\\p{N}]+"),
                                        lambda w: F.substring(w, 1, 1)), "")
    found = entities.filter(F.startswith(low, F.lit(text.lower())) | (initials == text.lower()))
    matching = found.select(key, name)
    # Activity is cut to the matching entities and reduced to one row each before the join.
    wanted = lookup_join(activity, key_set(matching, [key]), [key], "left_semi")
    last = wanted.groupBy(key).agg(F.max(activity_ts).alias("last_active"))
    return top_k(matching.join(last, key, "left"),
                 [F.col("last_active").desc_nulls_last(), F.col(key)], k)


def point_lookup(table: DataFrame, key_list: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the listed keys."""
    return table.join(key_set(key_list, keys), list(keys), "left_semi")


def audit_trail(log: DataFrame, owners: DataFrame, key: str, ts: str, who: Column | None = None) -> DataFrame:
    """Log rows of the sessions of some users, in time order."""
    chosen = owners if who is None else owners.filter(who)
    return lookup_join(log, chosen, [key]).orderBy(ts, key)


def trace(messages: DataFrame, calls: DataFrame, session: str, message_ts: str, call_ts: str,
          call_id: str, payload: Sequence[str]) -> DataFrame:
    """Each message with the next call of its session, and seconds until it; none gives NULL."""
    joined = asof_join(messages, calls, [session], message_ts, call_ts, [call_id, *payload],
                       call_id, direction="forward")
    return joined.withColumn("seconds_to_call", gap_seconds(message_ts, f"matched_{call_ts}"))


def tools_used(calls: DataFrame, keys: Sequence[str], tool: str, expected: Sequence[str]) -> DataFrame:
    """Per turn: how many of the expected tools were used, and whether all were."""
    flags = [F.max((F.col(tool) == name).cast("long")).alias(f"_{i}") for i, name in enumerate(expected)]
    used = calls.groupBy(*keys).agg(*flags)
    total = sum((F.col(f"_{i}") for i in range(len(expected))), F.lit(0).cast("long"))
    return used.select(*keys, total.alias("n_used"), (total == len(expected)).alias("all_used"))


def federated_join(remote: DataFrame, local: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join rows read from an operational store with a lake table.

    Filters and columns chosen on ``remote`` before the call are pushed to its source. The
    smaller side is broadcast only if its size is known to be small.
    """
    if planned_bytes(remote) <= BROADCAST_LIMIT:
        return local.join(F.broadcast(remote), list(on))
    return lookup_join(remote, local, on)
