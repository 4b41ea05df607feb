"""Scans, projections, joins, aggregates, per-key selection and set checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.timing import newer_than, stamp
from millrace.operators import cdc, checks
from millrace.operators import keyed as K
from millrace.operators import relational as rel
from millrace.plans import roles
from millrace.plans.registry import query
from millrace.sources.tables import Tables


# --- scans ----------------------------------------------------------------------------------

@query("scan_ordered", "SELECT * FROM customer ORDER BY c_custkey")
def scan_ordered(t: Tables) -> DataFrame:
    return t.customer.orderBy("c_custkey")


@query("point_lookup", """SELECT * FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup')""")
def point_lookup(t: Tables) -> DataFrame:
    signed_up = t.events.filter(F.col("event_type") == "signup")
    return rel.point_lookup(t.customer, signed_up.select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


@query("inline_values", """WITH tiers(c_mktsegment, tier) AS (
  VALUES ('HOUSEHOLD', 'gold'), ('MACHINERY', 'silver'), ('BUILDING', 'silver'))
SELECT coalesce(tier, 'standard') AS tier, count(*) AS n, round(sum(c_acctbal), 2) AS balance
FROM customer LEFT JOIN tiers USING (c_mktsegment) GROUP BY 1""")
def inline_values(t: Tables) -> DataFrame:
    tiers = t.spark.sql("SELECT * FROM VALUES ('HOUSEHOLD', 'gold'), ('MACHINERY', 'silver'), "
                        "('BUILDING', 'silver') AS v(c_mktsegment, tier)")
    return (t.customer.join(tiers, "c_mktsegment", "left")
            .groupBy(F.coalesce("tier", F.lit("standard")).alias("tier"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")))


#: Columns of every table in order, with their types.
_LISTED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@query("schema_introspect", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{c.split()[0]}' AS column_name, CAST({i} AS BIGINT) AS position, "
    f"CASE any_value(typeof({c.split()[0]})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
    f"WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END "
    f"AS data_type, count(*) AS n_rows, count(*) - count({c.split()[0]}) AS n_null FROM {name}"
    for name, columns in _LISTED.items() for i, c in enumerate(columns.split(", "), 1)))
def schema_introspect(t: Tables) -> DataFrame:
    return checks.describe_tables({name: getattr(t, name) for name in _LISTED})


# --- projections and predicates -------------------------------------------------------------

@query("project_alias", """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  o_totalprice AS amount, o_orderdate AS placed_at FROM orders""")
def project_alias(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                           F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("placed_at"))


@query("filter_in_range", """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_quantity >= 10 AND l_quantity < 20
  AND l_shipdate >= TIMESTAMP '2000-01-01'""")
def filter_in_range(t: Tables) -> DataFrame:
    return (t.lineitem.filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_quantity") >= 10)
                              & (F.col("l_quantity") < 20)
                              & (F.col("l_shipdate") >= stamp("2000-01-01 00:00:00")))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"))


@query("null_counts", """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'doc_id' AS column_name, count(doc_id) AS n_present, count(*) - count(doc_id) AS n_null FROM j
UNION ALL SELECT 'lang', count(lang), count(*) - count(lang) FROM j
UNION ALL SELECT 'quality', count(quality), count(*) - count(quality) FROM j
UNION ALL SELECT 'toxic', count(toxic), count(*) - count(toxic) FROM j""")
def null_counts(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rel.null_counts(joined, ["doc_id", "lang", "quality", "toxic"])


@query("recent_failures", f"""WITH {roles.CALLS_SQL}
SELECT event_id, session_id, ts FROM calls WHERE NOT ok
  AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '2024-01-30 12:00:00'""")
def recent_failures(t: Tables) -> DataFrame:
    return (roles.calls(t).filter(~F.col("ok") & newer_than("ts", "2024-01-30 12:00:00", hours=1))
            .select("event_id", "session_id", "ts"))


@query("recent_rows", """SELECT event_id, user_id, ts FROM events
WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-30'""")
def recent_rows(t: Tables) -> DataFrame:
    return t.events.filter(newer_than("ts", "2024-01-30 00:00:00", days=7)).select("event_id", "user_id", "ts")


@query("json_filter", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 AND event_type = 'purchase'""")
def json_filter(t: Tables) -> DataFrame:
    found = roles.call_arguments(t).between(["k"], 50)
    return (found.filter(F.col("event_type") == "purchase")
            .select("event_id", F.variant_get("props", "$.k", "long").alias("k")))


_CARDS_SQL = """SELECT doc_id, to_json({'source': source, 'meta': {'lang': lang, 'n_chars': n_chars},
  'tags': [{'name': 'lang', 'value': lang}, {'name': 'source', 'value': source}]}) AS card FROM documents"""


@query("json_contains", f"""WITH cards AS ({_CARDS_SQL})
SELECT doc_id, CAST(json_extract(card, '$.meta.n_chars') AS BIGINT) AS n_chars FROM cards
WHERE json_extract_string(card, '$.meta.lang') = 'fr' AND json_extract_string(card, '$.tags[1].value') = 'src7'""")
def json_contains(t: Tables) -> DataFrame:
    """Containment over several paths; name and value have to stand in the same element."""
    found = roles.document_cards(t).find({"meta": {"lang": "fr"}, "tags": [{"name": "source", "value": "src7"}]})
    return found.select("doc_id", F.variant_get("card", "$.meta.n_chars", "long").alias("n_chars"))


@query("json_paths", """WITH nodes AS (
  SELECT doc_id, unnest(['$', '$["meta"]', '$["tags"]', '$["tags"][]', '$["tags"][]']) AS path,
    unnest(['object', 'object', 'array', 'object', 'object']) AS kind FROM documents
  UNION ALL SELECT doc_id, '$["source"]', 'string' FROM documents WHERE source IS NOT NULL
  UNION ALL SELECT doc_id, '$["meta"]["lang"]', 'string' FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT doc_id, '$["meta"]["n_chars"]', 'number' FROM documents WHERE n_chars IS NOT NULL
  UNION ALL SELECT doc_id, '$["tags"][]["name"]', 'string' FROM (SELECT doc_id, unnest([1, 2]) FROM documents)
  UNION ALL SELECT doc_id, '$["tags"][]["value"]', 'string' FROM (SELECT doc_id, unnest([lang, source]) AS v FROM documents) WHERE v IS NOT NULL)
SELECT path, kind, count(DISTINCT doc_id) AS n_rows, count(*) AS n_nodes FROM nodes GROUP BY 1, 2""")
def json_paths(t: Tables) -> DataFrame:
    """Which paths the cards have; from the index alone."""
    return roles.document_cards(t).paths()


@query("summary_search", """SELECT doc_id, source FROM documents
WHERE contains(lower(text), 'license')""")
def summary_search(t: Tables) -> DataFrame:
    return t.documents.filter(F.contains(F.lower("text"), F.lit("license"))).select("doc_id", "source")


@query("customer_search", """WITH found AS (
  SELECT c_custkey, c_name FROM customer WHERE lower(c_name) LIKE 'customer#0000001%'),
last AS (SELECT o_custkey, max(o_orderdate) AS last_active FROM orders GROUP BY 1)
SELECT c_custkey, c_name, last_active FROM found LEFT JOIN last ON o_custkey = c_custkey
ORDER BY last_active DESC NULLS LAST, c_custkey LIMIT 50""")
def customer_search(t: Tables) -> DataFrame:
    activity = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return rel.entity_search(t.customer, "c_custkey", "c_name", activity, "o_orderdate",
                             "customer#0000001", 50)


@query("initials_search", """WITH found AS (
  SELECT p_partkey, p_name FROM part
  WHERE list_aggregate(list_transform(string_split(lower(p_name), ' '), lambda w: w[1]), 'string_agg', '') = 'rb'
     OR starts_with(lower(p_name), 'rb')),
last AS (SELECT l_partkey, max(l_shipdate) AS last_active FROM lineitem GROUP BY 1)
SELECT p_partkey, p_name, last_active FROM found LEFT JOIN last ON l_partkey = p_partkey
ORDER BY last_active DESC NULLS LAST, p_partkey LIMIT 50""")
def initials_search(t: Tables) -> DataFrame:
    activity = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_shipdate")
    return rel.entity_search(t.part, "p_partkey", "p_name", activity, "l_shipdate", "rb", 50)


@query("tool_arg_filter", f"""WITH {roles.CALLS_SQL}
SELECT event_id, session_id, ts FROM calls
WHERE tool_name = 'click' AND json_extract_string(args, '$.k') = '42'""")
def tool_arg_filter(t: Tables) -> DataFrame:
    store = roles.call_arguments(t)
    found = store.find({"k": 42}).unionByName(store.find({"k": "42"}))  # a number or its text
    return (found.filter(F.col("event_type") == "click")
            .select("event_id", F.col("user_id").alias("session_id"), "ts"))


@query("slow_calls", f"""WITH {roles.CALLS_SQL}
SELECT event_id, tool_name, duration_ms FROM calls WHERE duration_ms > 500""")
def slow_calls(t: Tables) -> DataFrame:
    return roles.calls(t).filter(F.col("duration_ms") > 500).select("event_id", "tool_name", "duration_ms")


# --- joins ----------------------------------------------------------------------------------

@query("join_inner", """SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(t: Tables) -> DataFrame:
    from millrace.functions.skew import lookup_join
    lookup = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    facts = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return lookup_join(facts, lookup, ["o_custkey"]).select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


@query("federated_join", """SELECT o_orderkey, o_orderdate, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate >= TIMESTAMP '2000-07-01' AND o_orderstatus = 'O' ORDER BY o_orderkey""")
def federated_join(t: Tables) -> DataFrame:
    remote = (t.orders.filter((F.col("o_orderdate") >= stamp("2000-07-01 00:00:00"))
                              & (F.col("o_orderstatus") == "O"))
              .select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("c_custkey")))
    local = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return (rel.federated_join(remote, local, ["c_custkey"])
            .select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment").orderBy("o_orderkey"))


@query("semi_join", """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def semi_join(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return rel.point_lookup(t.customer, urgent.select(F.col("o_custkey").alias("c_custkey")),
                            ["c_custkey"]).select("c_custkey", "c_name")


@query("audit_trail", f"""WITH {roles.CALLS_SQL}
SELECT session_id, event_id, tool_name, duration_ms, ok, ts, c_name AS user_name
FROM calls JOIN customer ON c_custkey = session_id WHERE c_mktsegment = 'BUILDING'
ORDER BY ts, session_id""")
def audit_trail(t: Tables) -> DataFrame:
    owners = t.customer.select(F.col("c_custkey").alias("session_id"), F.col("c_name").alias("user_name"),
                               "c_mktsegment")
    log = roles.calls(t).drop("args")
    return rel.audit_trail(log, owners, "session_id", "ts", F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")


@query("trace_join", f"""WITH {roles.CALLS_SQL},
m AS (SELECT event_id AS message_id, session_id, ts AS said_at FROM calls WHERE tool_name = 'view'),
p AS (SELECT event_id AS call_id, session_id, ts AS called_at, duration_ms FROM calls
      WHERE tool_name = 'purchase')
SELECT message_id, m.session_id, said_at, call_id, called_at AS matched_called_at, duration_ms,
       (epoch_us(called_at) - epoch_us(said_at)) / 1e6 AS seconds_to_call
FROM m ASOF LEFT JOIN p ON m.session_id = p.session_id AND m.said_at <= p.called_at""")
def trace_join(t: Tables) -> DataFrame:
    log = roles.calls(t)
    messages = log.filter(F.col("tool_name") == "view").select(
        F.col("event_id").alias("message_id"), "session_id", F.col("ts").alias("said_at"))
    calls = log.filter(F.col("tool_name") == "purchase").select(
        F.col("event_id").alias("call_id"), "session_id", F.col("ts").alias("called_at"), "duration_ms")
    return rel.trace(messages, calls, "session_id", "said_at", "called_at", "call_id", ["duration_ms"])


@query("asof_state", """WITH c AS (SELECT event_id AS crash_id, user_id, ts AS crashed_at FROM events
  WHERE event_type = 'error'),
s AS (SELECT event_id AS state_id, user_id, ts AS saved_at, event_type AS state FROM events
  WHERE event_type <> 'error')
SELECT crash_id, c.user_id, crashed_at, state_id, state, saved_at AS matched_saved_at
FROM c ASOF LEFT JOIN s ON c.user_id = s.user_id AND c.crashed_at >= s.saved_at""")
def asof_state(t: Tables) -> DataFrame:
    crashes = t.events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("crash_id"), "user_id", F.col("ts").alias("crashed_at"))
    states = t.events.filter(F.col("event_type") != "error").select(
        F.col("event_id").alias("state_id"), "user_id", F.col("ts").alias("saved_at"),
        F.col("event_type").alias("state"))
    return K.asof_join(crashes, states, ["user_id"], "crashed_at", "saved_at", ["state_id", "state"], "state_id")


@query("time_to_resolve", """SELECT l_orderkey AS o_orderkey, l_linenumber, l_returnflag,
  (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1e6 AS seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def time_to_resolve(t: Tables) -> DataFrame:
    shipped = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_shipdate")
    return (rel.resolve_times(t.orders, shipped, "o_orderkey", "o_orderdate", "l_shipdate")
            .select("o_orderkey", "l_linenumber", "l_returnflag", "seconds"))


@query("reconcile_rows", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT o_orderkey, 'missing_in_target' AS problem FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM after)
UNION ALL
SELECT o_orderkey, 'missing_in_source' FROM after WHERE o_orderkey NOT IN (SELECT o_orderkey FROM before)""")
def reconcile_rows(t: Tables) -> DataFrame:
    source, target = roles.orders_before(t), roles.orders_after(t)
    lost = checks.expected_subset(source, target, roles.ORDER_KEY)
    extra = checks.expected_subset(target, source, roles.ORDER_KEY)
    return (lost.withColumn("problem", F.lit("missing_in_target"))
            .unionByName(extra.withColumn("problem", F.lit("missing_in_source"))))


# --- aggregates -----------------------------------------------------------------------------

@query("count_all", "SELECT count(*) AS n FROM lineitem")
def count_all(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("group_count", """SELECT o_orderpriority, count(*) AS n FROM orders
GROUP BY 1 ORDER BY n DESC, o_orderpriority""")
def group_count(t: Tables) -> DataFrame:
    return rel.group_count(t.orders, ["o_orderpriority"])


@query("count_distinct", """SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1""")
def count_distinct(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))


@query("distinct_values", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(t: Tables) -> DataFrame:
    return t.events.select("event_type", "user_id").distinct()


@query("tool_audit", f"""WITH {roles.CALLS_SQL}
SELECT tool_name, count(*) AS n_calls, round(avg(duration_ms), 1) AS avg_ms, max(ts) AS last_call
FROM calls GROUP BY 1 ORDER BY n_calls DESC, tool_name""")
def tool_audit(t: Tables) -> DataFrame:
    return rel.call_summary(roles.calls(t), "tool_name", "duration_ms", "ts")


@query("tool_success_rate", f"""WITH b AS (SELECT user_id, event_type <> 'error' AS ok FROM events)
SELECT user_id, count(*) AS n_calls, count(*) FILTER (WHERE NOT ok) AS n_failed,
       round(avg(CAST(ok AS DOUBLE)), 4) AS success_rate FROM b GROUP BY 1""")
def tool_success_rate(t: Tables) -> DataFrame:
    return rel.success_rate(t.events, "user_id", F.col("event_type") != "error")


@query("daily_rollup", """SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, count(*) AS n,
  round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1 ORDER BY day DESC LIMIT 30""")
def daily_rollup(t: Tables) -> DataFrame:
    return rel.daily_rollup(t.orders, "o_orderdate", 30, revenue=F.round(F.sum("o_totalprice"), 2))


@query("avg_time_to_resolve", """SELECT l_returnflag, count(*) AS n,
  round(CAST(sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) AS DOUBLE) / count(*) / 1e6, 1) AS avg_seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def avg_time_to_resolve(t: Tables) -> DataFrame:
    shipped = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_shipdate")
    return rel.mean_resolve_time(t.orders, shipped, "o_orderkey", "o_orderdate", "l_shipdate", "l_returnflag")


@query("latency_summary", f"""WITH {roles.CALLS_SQL},
r AS (SELECT tool_name, duration_ms, row_number() OVER (PARTITION BY tool_name ORDER BY duration_ms) - 1 AS i,
             count(*) OVER (PARTITION BY tool_name) AS n FROM calls)
SELECT tool_name, any_value(n) AS n, round(avg(duration_ms), 3) AS mean,
       max(duration_ms) FILTER (WHERE i = least(CAST(floor(0.95::DOUBLE * n) AS BIGINT), n - 1)) AS p95
FROM r GROUP BY 1""")
def latency_summary(t: Tables) -> DataFrame:
    return rel.latency_summary(roles.calls(t), ["tool_name"], "duration_ms")


@query("group_count_multi", """SELECT r_name AS region, c_mktsegment AS tier, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2 ORDER BY n DESC, region, tier""")
def group_count_multi(t: Tables) -> DataFrame:
    # Customers are counted per nation and tier first; names are attached to the few counts.
    counted = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("c"))
    named = (counted.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return (named.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("tier"))
            .agg(F.sum("c").alias("n")).orderBy(F.col("n").desc(), "region", "tier"))


@query("hourly_rollup", """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type,
  count(*) AS n, round(sum(value), 2) AS total, max(value) AS peak FROM events GROUP BY 1, 2""")
def hourly_rollup(t: Tables) -> DataFrame:
    return rel.time_rollup(t.events, "ts", "1 hour", ["event_type"], "value")


# --- per-key selection ----------------------------------------------------------------------

@query("recent_orders", """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank
  FROM orders) WHERE rank <= 10""")
def recent_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return K.last_n_per_key(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                            10, rank_as="rank")


@query("latest_per_key", """SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    return K.latest_per_key(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


@query("top_k", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_k(t: Tables) -> DataFrame:
    return K.top_k(t.orders.select("o_orderkey", "o_totalprice"),
                   [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


@query("batch_topk", """SELECT p_brand, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (
  SELECT p_brand, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         row_number() OVER (PARTITION BY p_brand
                            ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE rank <= 5""")
def batch_topk(t: Tables) -> DataFrame:
    from millrace.functions.skew import lookup_join
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return K.last_n_per_key(
        lookup_join(lines, brands, ["l_partkey"]), ["p_brand"],
        [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"], 5,
        rank_as="rank")


# --- sets -----------------------------------------------------------------------------------

@query("expected_subset", """SELECT DISTINCT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def expected_subset(t: Tables) -> DataFrame:
    buyers = t.events.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("c_custkey"))
    return checks.expected_subset(t.customer, buyers, ["c_custkey"])


@query("snapshot_equal", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT *, CAST(1 AS BIGINT) AS extra_in_a FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after)
UNION ALL
SELECT *, CAST(-1 AS BIGINT) FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before)""")
def snapshot_equal(t: Tables) -> DataFrame:
    return cdc.snapshot_difference(roles.orders_before(t), roles.orders_after(t))
