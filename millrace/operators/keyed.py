"""Per-key selection: latest row, last n rows, top k, positions, as-of lookups, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.skew import lookup_join, settle
from millrace.functions.timing import micros
from millrace.session import shared_dir

#: Pieces into which one sketch cuts the candidate values of a quantile.
_GRID = 200

# ``row_number() <= n`` lets Spark cut every key to n rows inside each map task before the
# shuffle (WindowGroupLimit), so a key holding a third of the table costs n rows per task.


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int,
                   rank_as: str | None = None) -> DataFrame:
    """First ``n`` rows of every key under ``order`` (pass descending columns for "last n")."""
    window = Window.partitionBy(*keys).orderBy(*_cols(order))
    name = rank_as or "_rank"
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked.withColumn(name, F.col(name).cast("long")) if rank_as else ranked.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return last_n_per_key(df, keys, order, 1)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """Best ``k`` rows overall; planned as TakeOrderedAndProject, without a global sort."""
    return df.orderBy(*_cols(order)).limit(k)


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number all rows 1..n under a total order, without a single-task window.

    The rows are range-partitioned and sorted, then checkpointed so that partition numbers stay
    fixed; a row's position is its place in its partition plus the sizes of the earlier ones.
    """
    shared_dir(df.sparkSession)
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    tagged = (laid_out.withColumn("_part", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id()
                          .bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition, so this window and the broadcast stay tiny.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_off") + F.col("_place") + 1)
            .drop("_part", "_place", "_off"))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
              payload: Sequence[str], tie: str, direction: str = "backward",
              slice_seconds: int = 86_400) -> DataFrame:
    """Attach to each left row the nearest right row of the same ``by`` key in time.

    ``backward`` takes the last right row at or before the left row, ``forward`` the first at or
    after it; equal times prefer the largest / smallest ``tie``. Left rows without a partner
    keep NULL payload columns.

    Keys are cut into time slices, so one busy key spreads over many tasks. What a slice
    inherits from other slices enters it as one extra row, computed from one row per slice.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    back = direction == "backward"
    by = list(by)
    taken = [c for c in (right_ts, *payload, tie) if c not in by]
    found = F.struct(*[F.col(c) for c in dict.fromkeys(taken)])
    right_type = right.select(found.alias("v")).schema["v"].dataType
    left_type = left.select(F.struct(*left.columns).alias("v")).schema["v"].dataType

    def cut(ts: str) -> Column:
        return F.floor(micros(ts) / F.lit(slice_seconds * 1_000_000)).cast("long")

    keyed = right.dropna(subset=[*by, right_ts])
    rights = keyed.select(*by, cut(right_ts).alias("_slice"), micros(right_ts).alias("_at"),
                          F.lit(1).alias("_side"), F.col(tie).alias("_tie"),
                          F.lit(None).cast(left_type).alias("_row"), found.alias("_found"))
    tie_type = rights.schema["_tie"].dataType
    lefts = left.select(*by, cut(left_ts).alias("_slice"), micros(left_ts).alias("_at"),
                        F.lit(2).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"),
                        F.struct(*left.columns).alias("_row"),
                        F.lit(None).cast(right_type).alias("_found"))

    def ordered(*names: str) -> list[Column]:
        return [F.col(n).asc() if back else F.col(n).desc() for n in names]

    # What each slice hands on: its last right row in walking order.
    ends = latest_per_key(
        rights, [*by, "_slice"],
        [F.col(n).desc() if back else F.col(n).asc() for n in ("_at", "_tie")])
    marks = ends.select(*by, "_slice", "_found").unionByName(
        lefts.select(*by, "_slice").distinct().withColumn("_found", F.lit(None).cast(right_type)))
    marks = marks.groupBy(*by, "_slice").agg(F.first("_found", ignorenulls=True).alias("_found"))
    earlier = (Window.partitionBy(*by).orderBy(*ordered("_slice"))
               .rowsBetween(Window.unboundedPreceding, -1))
    inherited = (marks.withColumn("_found", F.last("_found", ignorenulls=True).over(earlier))
                 .filter(F.col("_found").isNotNull())
                 .select(*by, "_slice", F.lit(None).cast("long").alias("_at"),
                         F.lit(0).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"),
                         F.lit(None).cast(left_type).alias("_row"), "_found"))
    walk = (Window.partitionBy(*by, "_slice")
            .orderBy((F.col("_side") == 0).desc(), *ordered("_at"), F.col("_side").asc(),
                     *ordered("_tie"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = rights.unionByName(lefts).unionByName(inherited)
    out = (merged.withColumn("_found", F.last("_found", ignorenulls=True).over(walk))
           .filter(F.col("_side") == 2))
    return out.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in payload],
                      F.col(f"_found.{right_ts}").alias(f"matched_{right_ts}"))


def sessions(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Idle-gap sessions per key: start, end, event count, running number.

    Events are first counted per gap-wide time slice. Two events in one slice are always less
    than a gap apart, so slices never straddle sessions and the ordered step sees at most one
    row per slice, however busy a key is.
    """
    width = gap_seconds * 1_000_000
    sliced = (events.withColumn("_at", micros(ts))
              .withColumn("_slice", F.floor(F.col("_at") / F.lit(width)))
              .groupBy(key, "_slice")
              .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"),
                   F.min("_at").alias("_lo"), F.max("_at").alias("_hi"),
                   F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy(key).orderBy("_slice")
    starts = (F.col("_lo") - F.lag("_hi").over(order) >= F.lit(width)) | F.lag("_hi").over(order).isNull()
    numbered = (sliced.withColumn("_new", starts.cast("int"))
                .withColumn("session_no", F.sum("_new").over(order)))
    return (numbered.groupBy(key, "session_no")
            .agg(F.min("_first").alias("started_at"), F.max("_last").alias("ended_at"),
                 F.sum("_n").alias("n_events")))


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, p: float = 0.95,
                 name: str = "p95", sort_rows: int = 1_000_000) -> DataFrame:
    """Exact nearest-rank quantile per key: element ``min(int(p*n), n-1)`` of the sorted values.

    While a key has more than ``sort_rows`` candidate values, a mergeable sketch brackets the
    element and everything outside the bracket is only counted. The few values left are counted
    per distinct value and walked in order, so no task ever sorts a whole group. A bracket that
    misses the element is discarded, which costs time but not exactness. A NULL key is a group.
    """
    # As one struct the keys are never NULL, so that joins on them find the NULL group too.
    group, keys = F.struct(*keys).alias("_group"), ["_group"]
    rows = df.select(group, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    size = F.col("_m")
    plan = settle(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
                  .withColumns({"_target": F.least(F.floor(F.lit(p) * size), size - 1), "_skip": F.lit(0).cast("long")}))
    columns = plan.columns

    def candidates() -> DataFrame:
        return lookup_join(rows, plan, keys).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))

    def largest() -> int:
        return plan.filter(F.col("_lo") < F.col("_hi")).agg(F.max("_m")).first()[0] or 0

    left = largest()
    while left > sort_rows:
        grid = F.percentile_approx("_v", F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)]), F.lit(50 * _GRID))
        cuts = settle(candidates().groupBy(*keys).agg(grid.alias("_cuts")))
        step = F.floor((F.col("_target") - F.col("_skip")) / size * _GRID).cast("int")
        narrowed = lookup_join(plan, cuts, keys).withColumns({
            "_a": F.col("_cuts")[F.greatest(step - 1, F.lit(0))],
            "_b": F.col("_cuts")[F.least(step + 2, F.lit(_GRID))]}).drop("_cuts")
        inside = (F.col("_v") >= F.col("_a")) & (F.col("_v") <= F.col("_b"))
        counts = (lookup_join(rows, settle(narrowed), keys)
                  .filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                  .groupBy(*columns, "_a", "_b")
                  .agg(F.count_if(F.col("_v") < F.col("_a")).alias("_below"), F.count_if(inside).alias("_in")))
        first = F.col("_skip") + F.col("_below")
        hit = (F.col("_target") >= first) & (F.col("_target") < first + F.col("_in"))
        plan = settle(counts.withColumns({
            "_lo": F.when(hit, F.col("_a")).otherwise(F.col("_lo")),
            "_hi": F.when(hit, F.col("_b")).otherwise(F.col("_hi")),
            "_skip": F.when(hit, first).otherwise(F.col("_skip")),
            "_m": F.when(hit, F.col("_in")).otherwise(size)}).select(*columns))
        before, left = left, largest()
        if left >= before:
            break
    counted = candidates().groupBy(*keys, "_target", "_skip", "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*keys).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("_cum", F.col("_skip") + F.sum("_c").over(running))
    return (reached.filter((F.col("_target") < F.col("_cum"))
                           & (F.col("_target") >= F.col("_cum") - F.col("_c")))
            .select("_group.*", F.col("_v").alias(name)))
