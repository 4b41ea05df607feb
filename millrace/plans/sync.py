"""Keyed writes, change feeds, past states and what-if views over the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.timing import stamp
from millrace.operators import cdc
from millrace.plans import roles
from millrace.plans.registry import query
from millrace.session import fresh_dir
from millrace.sources.tables import Tables, VersionedTable

KEY = roles.ORDER_KEY
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_LISTED = ", ".join(COLUMNS)


@query("merge_upsert", f"""WITH {roles.CORRECTIONS_SQL}
SELECT coalesce(s.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE b.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE b.o_orderdate END AS o_orderdate,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority
FROM before b FULL JOIN source s ON b.o_orderkey = s.o_orderkey""")
def merge_upsert(t: Tables) -> DataFrame:
    return cdc.merge_upsert(roles.orders_before(t), roles.price_corrections(t), KEY)


@query("merge_insert_only", f"""WITH {roles.CORRECTIONS_SQL}
SELECT * FROM before UNION ALL
SELECT s.* FROM source s WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.o_orderkey = s.o_orderkey)""")
def merge_insert_only(t: Tables) -> DataFrame:
    return cdc.merge_insert_only(roles.orders_before(t), roles.price_corrections(t), KEY)


_LAST = f"""last AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_timestamp DESC) AS r
  FROM history) WHERE r = 1)"""


@query("apply_changes", f"""WITH {roles.HISTORY_SQL}, {_LAST},
before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
SELECT * FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
UNION ALL SELECT {_LISTED} FROM last WHERE _change_type <> 'delete'""")
def apply_changes(t: Tables) -> DataFrame:
    return cdc.apply_changes(roles.orders_before(t), roles.order_history(t), KEY)


@query("apply_changes_ordered", f"""WITH {roles.HISTORY_SQL}, {_LAST},
before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
fresh AS (SELECT l.* FROM last l LEFT JOIN before b ON b.o_orderkey = l.o_orderkey
          WHERE b.o_orderkey IS NULL OR l._commit_timestamp >= b.o_orderdate)
SELECT * FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)
UNION ALL SELECT {_LISTED} FROM fresh WHERE _change_type <> 'delete'""")
def apply_changes_ordered(t: Tables) -> DataFrame:
    return cdc.apply_changes_ordered(roles.orders_before(t), roles.order_history(t), KEY, "o_orderdate")


@query("apply_changes_late", f"""WITH {roles.HISTORY_SQL},
before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, _change_type = 'delete' ORDER BY _commit_timestamp DESC) AS r FROM history),
gone AS (SELECT o_orderkey, _commit_timestamp AS deleted FROM ranked WHERE r = 1 AND _change_type = 'delete'),
late AS (SELECT * FROM ranked WHERE r = 1 AND _change_type <> 'delete'),
fresh AS (SELECT l.* FROM late l LEFT JOIN gone g USING (o_orderkey)
          LEFT JOIN (SELECT o_orderkey, o_orderdate AS stored FROM before) b USING (o_orderkey)
          WHERE (g.o_orderkey IS NULL OR l._commit_timestamp >= g.deleted)
            AND (b.o_orderkey IS NULL OR g.o_orderkey IS NOT NULL OR l._commit_timestamp >= b.stored)),
after AS (SELECT b.* FROM before b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone))
SELECT * FROM after WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)
UNION ALL SELECT {_LISTED} FROM fresh""")
def apply_changes_late(t: Tables) -> DataFrame:
    """The deletions arrive first, all other changes in a later batch; no older change brings a row back."""
    history = roles.order_history(t)
    deletions, rest = history.filter("_change_type = 'delete'"), history.filter("_change_type <> 'delete'")
    first = cdc.apply_changes(roles.orders_before(t), deletions, KEY)
    gone = cdc.next_tombstones(None, deletions, KEY)
    return cdc.apply_changes_ordered(first, rest, KEY, "o_orderdate", tombstones=gone)


@query("insert_ignore", """WITH incoming AS (SELECT user_id, event_id, ts, row_number() OVER (
    PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type = 'signup'),
existing AS (SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id,
    CAST(NULL AS TIMESTAMP) AS ts FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT * FROM existing UNION ALL
SELECT user_id, event_id, ts FROM incoming WHERE r = 1 AND user_id NOT IN (SELECT user_id FROM existing)""")
def insert_ignore(t: Tables) -> DataFrame:
    existing = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("user_id"), F.lit(-1).cast("long").alias("event_id"),
        F.lit(None).cast("timestamp_ntz").alias("ts"))
    incoming = t.events.filter(F.col("event_type") == "signup").select("user_id", "event_id", "ts")
    return cdc.insert_ignore(existing, incoming, ["user_id"], ["ts", "event_id"])


@query("insert_fk_lookup", """SELECT event_id, value, c_custkey AS customer_id FROM events
LEFT JOIN customer ON c_name = 'Customer#' || lpad(CAST(user_id * 11 AS VARCHAR), 9, '0')""")
def insert_fk_lookup(t: Tables) -> DataFrame:
    incoming = t.events.select(
        "event_id", "value",
        F.concat(F.lit("Customer#"), F.lpad((F.col("user_id") * 11).cast("string"), 9, "0")).alias("c_name"))
    lookup = t.customer.select("c_name", "c_custkey")
    return cdc.insert_fk_lookup(incoming, lookup, "c_name", "c_custkey", "customer_id")


@query("update_where", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1998-01-01' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders""")
def update_where(t: Tables) -> DataFrame:
    overdue = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < stamp("1998-01-01 00:00:00"))
    return cdc.update_where(t.orders, overdue, o_orderstatus=F.lit("F"), o_totalprice=F.col("o_totalprice") + 5)


@query("backfill_first_n", """WITH chosen AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'
  ORDER BY o_orderkey LIMIT 500)
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM chosen) THEN 'B' ELSE o_orderstatus END
  AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def backfill_first_n(t: Tables) -> DataFrame:
    return cdc.backfill_first_n(t.orders, "o_orderkey", 500, F.col("o_orderstatus") == "P",
                                o_orderstatus=F.lit("B"))


@query("delete_where", """WITH j AS (SELECT d.doc_id, d.source, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT * FROM j WHERE NOT coalesce(toxic = 0, false)""")
def delete_where(t: Tables) -> DataFrame:
    rated = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    return cdc.delete_where(rated, F.col("toxic") == 0)


@query("delete_cascade", """WITH s AS (SELECT conv_id, count(*) AS n, max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) AS has_system
  FROM conversations GROUP BY 1)
SELECT conv_id, turn, role, text FROM conversations
WHERE conv_id NOT IN (SELECT conv_id FROM s WHERE has_system = 1)""")
def delete_cascade(t: Tables) -> DataFrame:
    sessions = t.conversations.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.max((F.col("role") == "system").cast("int")).alias("has_system"))
    _, kept = cdc.delete_cascade(sessions, F.col("has_system") == 1, "conv_id", {"messages": t.conversations})
    return kept["messages"]


@query("sync_snapshot", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def sync_snapshot(t: Tables) -> DataFrame:
    return cdc.sync_snapshot(t.orders, ["o_orderkey"], ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


@query("sync_rejects", """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
  CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'missing key' ELSE 'repeated key' END AS reason
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
WHERE n > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def sync_rejects(t: Tables) -> DataFrame:
    """Line items whose key is not one: the generated line numbers repeat."""
    return cdc.sync_rejects(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"])


_FEED = """feed AS (
  SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
         coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
         CASE WHEN b.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS _change_type,
         TIMESTAMP '2001-09-01' AS _commit_timestamp
  FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
     OR a.o_totalprice IS DISTINCT FROM b.o_totalprice)"""


def _feed(t: Tables) -> DataFrame:
    return cdc.change_feed(roles.orders_before(t), roles.orders_after(t), KEY, stamp("2001-09-01 00:00:00"))


@query("change_feed", f"WITH {roles.SNAPSHOTS_SQL}, {_FEED} SELECT * FROM feed")
def change_feed(t: Tables) -> DataFrame:
    return _feed(t).select("o_orderkey", "o_orderstatus", "o_totalprice", "_change_type", "_commit_timestamp")


@query("history_append", f"""WITH {roles.SNAPSHOTS_SQL}, {_FEED}
SELECT o_orderkey, _change_type, _commit_timestamp FROM feed""")
def history_append(t: Tables) -> DataFrame:
    feed = _feed(t)
    first = feed.filter(F.col("_change_type") != "update")
    # The whole feed again after its first part: what was appended before is not repeated.
    return cdc.append_history(first, feed, KEY).select("o_orderkey", "_change_type", "_commit_timestamp")


@query("change_history", f"""WITH {roles.HISTORY_SQL}
SELECT o_orderkey, o_orderstatus, o_totalprice, _change_type, _commit_timestamp FROM history
WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 450000)
ORDER BY _commit_timestamp, o_orderkey""")
def change_history(t: Tables) -> DataFrame:
    large = t.orders.filter(F.col("o_totalprice") > 450000)
    history = roles.order_history(t).select("o_orderkey", "o_orderstatus", "o_totalprice", "_change_type",
                                            "_commit_timestamp")
    return cdc.change_history(history, large, KEY)


@query("current_from_history", f"""WITH {roles.HISTORY_SQL}, {_LAST}
SELECT {_LISTED} FROM last WHERE _change_type <> 'delete'""")
def current_from_history(t: Tables) -> DataFrame:
    return cdc.current_from_history(roles.order_history(t), KEY, COLUMNS)


_AS_OF = f"""past AS (SELECT {_LISTED} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_timestamp DESC) AS r
  FROM history WHERE _commit_timestamp <= TIMESTAMP '1999-06-30') WHERE r = 1 AND _change_type <> 'delete')"""


@query("as_of", f"WITH {roles.HISTORY_SQL}, {_AS_OF} SELECT * FROM past")
def as_of(t: Tables) -> DataFrame:
    return cdc.as_of(roles.order_history(t), KEY, COLUMNS, stamp("1999-06-30 00:00:00"))


@query("restore_rows", f"""WITH {roles.HISTORY_SQL}, {_AS_OF},
current AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'oops' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM')
SELECT p.* FROM past p LEFT JOIN current c USING (o_orderkey) WHERE c.o_orderkey IS NULL OR c.o_orderstatus = 'oops'
UNION ALL
SELECT c.* FROM current c WHERE c.o_orderstatus <> 'oops' OR c.o_orderkey NOT IN (SELECT o_orderkey FROM past)""")
def restore_rows(t: Tables) -> DataFrame:
    # High-priority rows were damaged and medium ones lost; both come back from the past state.
    current = (t.orders.filter(F.col("o_orderpriority") != "3-MEDIUM")
               .withColumn("o_orderstatus", F.when(F.col("o_orderpriority") == "2-HIGH", "oops")
                           .otherwise(F.col("o_orderstatus"))))
    return cdc.restore_rows(current, as_of(t), KEY, F.col("o_orderstatus") == "oops")


def _branch(t: Tables) -> DataFrame:
    """A branch's own changes: urgent orders deleted, the rest of the corrections applied."""
    at = stamp("2001-10-01 00:00:00")
    return roles.price_corrections(t).withColumns({
        "_change_type": F.when(F.col("o_orderpriority") == "1-URGENT", "delete").otherwise("update"),
        "_commit_timestamp": at})


@query("overlay_view", f"""WITH {roles.CORRECTIONS_SQL}
SELECT * FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
UNION ALL SELECT * FROM source WHERE o_orderpriority <> '1-URGENT'""")
def overlay_view(t: Tables) -> DataFrame:
    return cdc.overlay(roles.orders_before(t), _branch(t), KEY)


@query("promote_conflicts", f"""WITH {roles.SNAPSHOTS_SQL}, {_FEED},
source AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '2001-01-01')
SELECT o_orderkey FROM feed WHERE o_orderkey IN (SELECT o_orderkey FROM source)""")
def promote_conflicts(t: Tables) -> DataFrame:
    return cdc.promote(roles.orders_before(t), _feed(t), _branch(t), KEY)[1]


@query("promote_view", f"""WITH {roles.SNAPSHOTS_SQL},
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '2001-01-01')
SELECT * FROM after WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
UNION ALL SELECT * FROM source WHERE o_orderpriority <> '1-URGENT'""")
def promote_view(t: Tables) -> DataFrame:
    return cdc.promote(roles.orders_before(t), _feed(t), _branch(t), KEY)[0]


@query("promote_approved", """SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)
WHERE l.quality = 1 AND l.toxic = 0 AND d.doc_id NOT IN (SELECT vec_id FROM embeddings WHERE label < 5)""")
def promote_approved(t: Tables) -> DataFrame:
    staging = t.documents.select("doc_id", "source").join(t.labels, "doc_id")
    promoted = t.embeddings.filter(F.col("label") < 5).select(F.col("vec_id").alias("doc_id"))
    return cdc.promote_approved(staging, promoted, ["doc_id"], F.col("quality") == 1,
                                F.col("toxic") == 1).drop("toxic")


@query("reconcile_versions", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'only_a' WHEN b.o_orderkey IS NULL THEN 'only_b'
       WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'changed' ELSE 'same' END AS status
FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey""")
def reconcile_versions(t: Tables) -> DataFrame:
    return cdc.reconcile_versions(roles.orders_before(t), roles.orders_after(t), KEY).select("o_orderkey", "status")


@query("take_versions", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT b.* FROM before b LEFT JOIN after a USING (o_orderkey)
WHERE a.o_orderkey IS NULL OR a.o_orderstatus = b.o_orderstatus
UNION ALL
SELECT a.* FROM after a LEFT JOIN before b USING (o_orderkey)
WHERE b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""")
def take_versions(t: Tables) -> DataFrame:
    compared = cdc.reconcile_versions(roles.orders_before(t), roles.orders_after(t), KEY)
    return cdc.take_statuses(compared, COLUMNS, ["only_a", "same"], ["only_b", "changed"])


@query("mirror_drift", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'missing' WHEN b.o_orderkey IS NULL THEN 'unexpected' ELSE 'changed' END AS drift
FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""")
def mirror_drift(t: Tables) -> DataFrame:
    return cdc.mirror_drift(roles.orders_before(t), roles.orders_after(t), KEY)


@query("freshness_lag", """WITH target AS (
  SELECT event_id, ts, date_trunc('hour', ts) + INTERVAL 1 HOUR AS applied_at FROM events
  WHERE ts < TIMESTAMP '2024-01-30')
SELECT count(t.event_id) AS n_visible, count(*) - count(t.event_id) AS n_pending,
  round(avg((epoch_us(applied_at) - epoch_us(e.ts)) / 1e6), 3) AS avg_lag_s,
  max((epoch_us(applied_at) - epoch_us(e.ts)) / 1e6) AS max_lag_s
FROM events e LEFT JOIN target t ON t.event_id = e.event_id AND t.ts = e.ts""")
def freshness_lag(t: Tables) -> DataFrame:
    # The mirror is loaded at every full hour and has not yet seen the last day.
    source = t.events.select("event_id", F.col("ts").alias("version"), F.col("ts").alias("committed_at"))
    target = t.events.filter(F.col("ts") < stamp("2024-01-30 00:00:00")).select(
        "event_id", F.col("ts").alias("version"),
        (F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.make_interval(hours=F.lit(1))).alias("applied_at"))
    return cdc.freshness_lag(source, target, ["event_id"], "version", "committed_at", "applied_at")


@query("append_generated_ids", """WITH top AS (SELECT max(event_id) AS m FROM events)
SELECT m + row_number() OVER (ORDER BY conv_id, turn) AS event_id, conv_id, turn, role FROM conversations, top""")
def append_generated_ids(t: Tables) -> DataFrame:
    # Message rows are appended to a log whose largest id is the last event's.
    log = t.events.select("event_id", F.lit(None).cast("long").alias("conv_id"),
                          F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"))
    return cdc.append_generated_ids(log, t.conversations.drop("text"), "event_id", ["conv_id", "turn"])[1]


@query("reload", """SELECT c_custkey, c_name, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
def reload(t: Tables) -> DataFrame:
    """Serving table loaded twice over: the second load replaces the first."""
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    profile = t.customer.select("c_custkey", "c_name", "c_mktsegment").join(spent, "c_custkey")
    table = VersionedTable(t.spark, fresh_dir(t.spark, "reload"))
    for _ in range(2):
        table.replace(profile, cluster_by=["c_custkey"], rows_per_file=1_000_000)
    return table.read()
