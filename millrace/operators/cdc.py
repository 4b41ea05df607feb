"""Keyed writes, change feeds and two-way sync, as DataFrame algebra.

Every operator returns the new state instead of changing its input; the caller writes it where
readers switch to it. Matching a large target with a small change set uses semi and anti joins,
which Spark can run by broadcasting the change keys, so the target is not shuffled.

Change rows carry the table's columns plus ``_change_type`` (insert, update, delete) and
``_commit_timestamp``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.skew import BROADCAST_LIMIT, key_set, lookup_join, planned_bytes
from millrace.operators.keyed import latest_per_key, positions

CHANGE_TYPE = "_change_type"
COMMIT_TS = "_commit_timestamp"


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe inequality over the named columns."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _side_by_side(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer match on the keys with each side as one struct, NULL where absent."""
    left = a.select(*keys, F.struct(*a.columns).alias("a"))
    right = b.select(*keys, F.struct(*b.columns).alias("b"))
    return left.join(right, list(keys), "full")


def _key_missing(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def _refuse(bad: Column, message: str, keys: Sequence[str]) -> Column:
    """True for good rows; raises, when the row is computed, for bad ones."""
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{message}: "), shown)).cast("boolean")).otherwise(F.lit(True))


def _per_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """Rows that share the row's key. Rows without a key are nobody's equals and are spread."""
    apart = F.when(_key_missing(keys), F.xxhash64(*df.columns)).otherwise(F.lit(0))
    return F.count(F.lit(1)).over(Window.partitionBy(*keys, apart))


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, raising while it is computed if two rows share a key. Rows without a key pass."""
    counted = df.withColumn("_same", _per_key(df, keys))
    twice = (F.col("_same") > 1) & ~_key_missing(keys)
    return counted.filter(_refuse(twice, "more than one row for key", keys)).drop("_same")


# --- merges ---------------------------------------------------------------------------------

def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take all source values, the rest of the source is inserted.

    Two source rows for one key are an error, raised when they are computed (reduce a change log
    with :func:`latest_changes` first). Source rows without a key match nothing and are inserted.
    """
    kept = target.join(key_set(source, keys), list(keys), "left_anti")
    return kept.unionByName(unique_keys(source, keys).select(*target.columns))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert source rows whose key is new; existing rows stay as they are."""
    new = source.join(key_set(target, keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """Insert the first row per new key under ``order``; conflicting rows are ignored."""
    if not keys:
        raise ValueError("insert_ignore needs key columns: without them nothing conflicts")
    return merge_insert_only(target, latest_per_key(source, keys, order), keys)


def latest_changes(changes: DataFrame, keys: Sequence[str], seq: str,
                   tie: Sequence[str | Column] = ()) -> DataFrame:
    """The last change of every key; ``tie`` decides between equal sequence values."""
    return latest_per_key(changes, keys, [F.col(seq).desc(), *tie])


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  seq: str = COMMIT_TS, tie: Sequence[str | Column] = (),
                  limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Fold a change log into a table: deletes remove, other changes replace or insert.

    A changed key ends with one row or none. All other target rows, those that repeat a key or
    have none included, stay as they are. A change without a key is an error, raised when it is
    computed. Up to ``limit`` planned bytes the change keys are broadcast, so the target stays where it is;
    a larger log meets the target in one shuffle. The rows are the same either way.
    """
    if planned_bytes(changes) > limit:
        return _fold(target, None, changes, keys, seq, tie, None)
    last = latest_changes(changes.filter(_refuse(_key_missing(keys), "change without a key", keys)), keys, seq, tie)
    return _replace(target, last, keys)


def _replace(target: DataFrame, last: DataFrame, keys: Sequence[str]) -> DataFrame:
    kept = target.join(F.broadcast(key_set(last, keys)), list(keys), "left_anti")
    return kept.unionByName(last.filter(F.col(CHANGE_TYPE) != "delete").select(*target.columns))


def apply_changes_ordered(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                          target_seq: str, seq: str = COMMIT_TS, tie: Sequence[str | Column] = (),
                          tombstones: DataFrame | None = None, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Like :func:`apply_changes`, but a change older than the stored row is ignored.

    A missing sequence value is older than any other; of several stored rows of a key the newest
    counts. ``tombstones`` (see :func:`next_tombstones`) holds when deleted keys were deleted, so
    that an older change arriving later does not bring them back.
    """
    if planned_bytes(changes) > limit:
        return _fold(target, target_seq, changes, keys, seq, tie, tombstones)
    last = latest_changes(changes.filter(_refuse(_key_missing(keys), "change without a key", keys)), keys, seq, tie)
    stored = target.select(*keys, F.col(target_seq).alias("_stored"))
    if tombstones is not None:
        stored = stored.unionByName(tombstones.select(*keys, F.col(seq).alias("_stored")))
    incoming = F.broadcast(last.select(*keys, F.col(seq).alias("_incoming")))
    older = (F.col("_incoming") < F.col("_stored")) | (F.col("_incoming").isNull() & F.col("_stored").isNotNull())
    stale = key_set(stored.join(incoming, list(keys)).filter(older), keys)
    return _replace(target, last.join(F.broadcast(stale), list(keys), "left_anti"), keys)


def _fold(target: DataFrame, target_seq: str | None, changes: DataFrame, keys: Sequence[str], seq: str,
          tie: Sequence[str | Column], tombstones: DataFrame | None) -> DataFrame:
    """Target, log and tombstones stacked: the last change of a key decides over its stored rows."""
    extra = [F.col(c) for c in tie if isinstance(c, str) and c not in target.columns]
    stored_seq = F.lit(None) if target_seq is None else F.col(target_seq)
    rows = (target.withColumns({CHANGE_TYPE: F.lit("stored"), "_seq": stored_seq.cast(changes.schema[seq].dataType), "_log": F.lit(0)})
            .unionByName(changes.filter(_refuse(_key_missing(keys), "change without a key", keys))
                         .select(*target.columns, CHANGE_TYPE, F.col(seq).alias("_seq"), F.lit(1).alias("_log"), *extra), allowMissingColumns=True))
    if tombstones is not None:
        rows = rows.unionByName(tombstones.select(*keys, F.lit("tombstone").alias(CHANGE_TYPE), F.col(seq).alias("_seq"), F.lit(0).alias("_log")),
                                allowMissingColumns=True)
    # Rows without a key are spread: nothing changes them.
    own = Window.partitionBy(*keys, F.when(_key_missing(keys), F.xxhash64(*target.columns)).otherwise(F.lit(0)))
    order = [F.col(c) if isinstance(c, str) else c for c in tie]
    newest = own.orderBy(F.col("_log").desc(), F.col("_seq").desc_nulls_last(), *order)
    rows = rows.withColumns({
        "_place": F.row_number().over(newest), "_incoming": F.first("_seq").over(newest), "_changed": F.max("_log").over(own),
        "_stored": F.max(F.when(F.col("_log") == 0, F.col("_seq"))).over(own)})
    older = (F.col("_incoming") < F.col("_stored")) | (F.col("_incoming").isNull() & F.col("_stored").isNotNull())
    applies = (F.col("_changed") == 1) & ~F.coalesce(older, F.lit(False))
    kind = F.col(CHANGE_TYPE)
    keep = (F.when(F.col("_log") == 1, applies & (F.col("_place") == 1) & (kind != "delete"))
            .when(kind == "tombstone", F.lit(False)).otherwise(~applies))
    return rows.filter(keep).select(*target.columns)


def next_tombstones(tombstones: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                    seq: str = COMMIT_TS, tie: Sequence[str | Column] = ()) -> DataFrame:
    """Keys whose newest known change is a deletion, and when it was made: the keys and ``seq``."""
    known = changes
    if tombstones is not None:
        known = tombstones.withColumn(CHANGE_TYPE, F.lit("delete")).unionByName(changes, allowMissingColumns=True)
    return latest_changes(known, keys, seq, tie).filter(F.col(CHANGE_TYPE) == "delete").select(*keys, seq)


def current_from_history(history: DataFrame, keys: Sequence[str], columns: Sequence[str],
                         seq: str = COMMIT_TS, tie: Sequence[str | Column] = ()) -> DataFrame:
    """Current rows of an append-only change history."""
    last = latest_changes(history, keys, seq, tie)
    return last.filter(F.col(CHANGE_TYPE) != "delete").select(*columns)


def as_of(history: DataFrame, keys: Sequence[str], columns: Sequence[str], at: Column,
          seq: str = COMMIT_TS, tie: Sequence[str | Column] = ()) -> DataFrame:
    """The table as it stood at a moment, changes at that very moment included."""
    return current_from_history(history.filter(F.col(seq) <= at), keys, columns, seq, tie)


def change_history(history: DataFrame, key_list: DataFrame, keys: Sequence[str],
                   seq: str = COMMIT_TS) -> DataFrame:
    """All changes of the listed keys in commit order."""
    wanted = lookup_join(history, key_set(key_list, keys), keys, "left_semi")
    return wanted.orderBy(seq, *keys)


# --- change feeds ---------------------------------------------------------------------------

def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Row changes that turn snapshot ``old`` into snapshot ``new``.

    Deletes carry the old values. A value that becomes or stops being NULL is an update.
    """
    values = [c for c in new.columns if c not in keys]
    both = _side_by_side(old, new, keys)
    kind = (F.when(F.col("a").isNull(), "insert").when(F.col("b").isNull(), "delete")
            .when(_differs("a", "b", values), "update"))
    row = F.coalesce(F.col("b"), F.col("a"))
    return (both.withColumn(CHANGE_TYPE, kind).filter(F.col(CHANGE_TYPE).isNotNull())
            .select(*[row[c].alias(c) for c in new.columns], CHANGE_TYPE, at.alias(COMMIT_TS)))


def append_history(history: DataFrame, feed: DataFrame, keys: Sequence[str],
                   seq: str = COMMIT_TS) -> DataFrame:
    """Append changes once; replayed changes are recognised and skipped.

    A change is its key, commit, kind and values. Different changes of a key at one commit, such
    as an insert and an update in one transaction, are all kept.
    """
    identity = change_identity(feed, keys, seq)
    known = history.select(F.struct(*identity).alias("_known")).distinct()
    fresh = feed.withColumn("_same", F.struct(*identity)).dropDuplicates(["_same"])
    return history.unionByName(fresh.join(known, fresh._same == known._known, "left_anti").select(*history.columns))


def change_identity(changes: DataFrame, keys: Sequence[str], seq: str = COMMIT_TS) -> list[Column]:
    """Commit, and a hash of the whole change with its key, kind and values; NULLs count."""
    values = sorted(c for c in changes.columns if c not in keys)
    shown = F.to_json(F.struct(*[F.col(c) for c in [*keys, *values]]))
    return [F.coalesce(F.col(seq).cast("string"), F.lit("")).alias("at"), F.sha2(shown, 256).alias("content")]


def sync_snapshot(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full refresh of a mirror: the source's columns, every row.

    A key that is missing or held by two rows is an error, raised when it is computed;
    :func:`sync_rejects` lists such rows.
    """
    rows = source.select(*columns)
    return unique_keys(rows.filter(_refuse(_key_missing(keys), "row without a key", keys)), keys)


def sync_rejects(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows a sync refuses, with ``reason``: missing key or repeated key."""
    rows = source.select(*columns)
    missing = _key_missing(keys)
    return (rows.withColumn("_same", _per_key(rows, keys)).filter(missing | (F.col("_same") > 1))
            .withColumn("reason", F.when(missing, "missing key").otherwise("repeated key")).drop("_same"))


def mirror_drift(source: DataFrame, mirror: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mirror rows the source does not explain; empty for a faithful read-only mirror."""
    values = [c for c in source.columns if c not in keys]
    both = _side_by_side(source, mirror.select(*source.columns), keys)
    kind = (F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected")
            .when(_differs("a", "b", values), "changed"))
    return both.select(*keys, kind.alias("drift")).filter(F.col("drift").isNotNull())


def freshness_lag(source: DataFrame, target: DataFrame, keys: Sequence[str], version: str,
                  committed: str, applied: str) -> DataFrame:
    """Seconds from source commit to visibility in the target: rows, mean, maximum, missing."""
    done = target.select(*keys, version, F.col(applied).alias("_applied"))
    pairs = source.join(done, [*keys, version], "left")
    lag = (F.unix_micros(F.col("_applied").cast("timestamp"))
           - F.unix_micros(F.col(committed).cast("timestamp"))) / F.lit(1e6)
    return pairs.agg(F.count(lag).alias("n_visible"),
                     F.count_if(F.col("_applied").isNull()).alias("n_pending"),
                     F.round(F.avg(lag), 3).alias("avg_lag_s"), F.max(lag).alias("max_lag_s"))


# --- plain DML ------------------------------------------------------------------------------

def append_generated_ids(target: DataFrame, batch: DataFrame, id_col: str,
                         order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Append a batch with ids continuing after the largest one. Returns (new table, new rows).

    ``order`` must order the batch totally, so that a rerun hands out the same ids.
    """
    top = target.agg(F.max(id_col)).first()[0] or 0
    numbered = positions(batch, order, "_position")
    rows = numbered.withColumn(id_col, F.lit(top) + F.col("_position"))
    inserted = rows.select(*target.columns)
    return target.unionByName(inserted), inserted


def insert_fk_lookup(incoming: DataFrame, lookup: DataFrame, natural: str, surrogate: str,
                     fk: str) -> DataFrame:
    """Resolve a natural key to its surrogate; unknown keys give NULL.

    A natural key with several surrogates is an error, raised when the row is computed.
    """
    ids = (lookup.groupBy(natural)
           .agg(F.min(surrogate).alias(fk), F.max(surrogate).alias("_other"))
           .withColumn(fk, F.when(F.col(fk) == F.col("_other"), F.col(fk))
                       .otherwise(F.raise_error(F.concat(
                           F.lit("more than one row for "), F.col(natural).cast("string")))))
           .drop("_other"))
    return lookup_join(incoming, ids, [natural], "left").drop(natural)


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Set columns on the rows where ``condition`` is true; NULL counts as not true."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)).cast(df.schema[name].dataType)
                           for name, value in values.items()})


def backfill_first_n(df: DataFrame, key: str, n: int, condition: Column | None = None,
                     **values: Column) -> DataFrame:
    """Update the first ``n`` rows by key, as in UPDATE ... IN (SELECT ... ORDER BY ... LIMIT n)."""
    pool = df if condition is None else df.filter(condition)
    chosen = pool.select(key).orderBy(key).limit(n).withColumn("_chosen", F.lit(True))
    flagged = lookup_join(df, chosen, [key], "left")
    return update_where(flagged, F.col("_chosen"), **values).select(*df.columns)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Keep the rows for which ``condition`` is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_cascade(parents: DataFrame, condition: Column, key: str,
                   cascading: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete parents and, in the named children, the rows that refer to them."""
    gone = key_set(parents.filter(condition), [key])
    children = {name: lookup_join(child, gone, [key], "left_anti") for name, child in cascading.items()}
    return delete_where(parents, condition), children


# --- past states and what-if views ----------------------------------------------------------

def restore_rows(current: DataFrame, past: DataFrame, keys: Sequence[str],
                 damaged: Column) -> DataFrame:
    """Copy rows back from a past state: damaged rows are replaced, lost rows return.

    One join of the two states; a damaged row without a past stays as it is.
    """
    flagged = current.withColumn("_damaged", F.coalesce(damaged, F.lit(False)))
    both = _side_by_side(flagged, past, keys)
    from_past = F.col("a").isNull() | (F.col("a._damaged") & F.col("b").isNotNull())
    return both.select(*[F.when(from_past, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
                         for c in current.columns])


def overlay(base: DataFrame, branch_changes: DataFrame, keys: Sequence[str],
            seq: str = COMMIT_TS) -> DataFrame:
    """A branch: the base plus the branch's own changes, computed lazily; the base is not written."""
    return apply_changes(base, branch_changes, keys, seq)


def promote(base: DataFrame, base_changes: DataFrame, branch_changes: DataFrame,
            keys: Sequence[str], seq: str = COMMIT_TS) -> tuple[DataFrame, DataFrame]:
    """State after promoting a branch, and the keys both sides changed (branch wins there)."""
    conflicts = key_set(base_changes, keys).join(key_set(branch_changes, keys), list(keys),
                                                 "left_semi")
    moved_on = apply_changes(base, base_changes, keys, seq)
    return overlay(moved_on, branch_changes, keys, seq), conflicts


def promote_approved(staging: DataFrame, target: DataFrame, keys: Sequence[str],
                     approved: Column, in_flight: Column) -> DataFrame:
    """Staged rows that are approved, not in flight and not yet in the target."""
    ready = staging.filter(approved & ~F.coalesce(in_flight, F.lit(False)))
    return ready.join(key_set(target, keys), list(keys), "left_anti")


def reconcile_versions(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare two versions by key: ``status`` is only_a, only_b, same or changed.

    Columns are the keys, ``status`` and the two rows as structs ``a`` and ``b``.
    """
    values = [c for c in a.columns if c not in keys]
    both = _side_by_side(a, b.select(*a.columns), keys)
    status = (F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b")
              .when(_differs("a", "b", values), "changed").otherwise("same"))
    return both.withColumn("status", status)


def take_statuses(compared: DataFrame, columns: Sequence[str], from_a: Sequence[str],
                  from_b: Sequence[str]) -> DataFrame:
    """Rows chosen from a comparison, each status naming the one version it is taken from."""
    if set(from_a) & set(from_b):
        raise ValueError("a status can be taken from one version only")
    a_side = F.col("status").isin(list(from_a))
    return (compared.filter(F.col("status").isin([*from_a, *from_b]))
            .select(*[F.when(a_side, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in columns]))


def snapshot_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``extra_in_a`` (negative: missing there).

    One shuffle over both tables; equal rows cancel before it. Empty means equal.
    """
    columns = a.columns
    signed = a.withColumn("_w", F.lit(1)).unionByName(
        b.select(*columns).withColumn("_w", F.lit(-1)))
    return (signed.groupBy(*columns).agg(F.sum("_w").alias("extra_in_a"))
            .filter(F.col("extra_in_a") != 0))
