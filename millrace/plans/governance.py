"""Row policies, grants and verification jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.timing import stamp
from millrace.operators import checks as C
from millrace.operators import checksums as X
from millrace.operators import security as S
from millrace.plans import roles
from millrace.plans.registry import query
from millrace.session import fresh_dir
from millrace.sources.tables import Tables


@query("rls_owner", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 42")
def rls_owner(t: Tables) -> DataFrame:
    return S.owned_by(t.orders, "o_custkey", 42).select("o_orderkey", "o_custkey", "o_totalprice")


@query("rls_region", """SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')""")
def rls_region(t: Tables) -> DataFrame:
    granted = t.region.filter(F.col("r_name").isin("ASIA", "EUROPE"))
    assignments = (t.nation.join(granted, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select(F.lit("bob").alias("principal"), F.col("n_nationkey").alias("c_nationkey")))
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (S.assigned_rows(t.customer, assignments, "bob", ["c_nationkey"]).join(names, "c_nationkey")
            .select("c_custkey", "c_name", "n_name"))


@query("rls_visibility", """SELECT o_custkey, count(*) AS n_visible, (SELECT count(*) FROM orders) AS n_total
FROM orders GROUP BY 1""")
def rls_visibility(t: Tables) -> DataFrame:
    return S.visible_counts(t.orders, "o_custkey")


@query("rls_isolation", """SELECT count(*) FILTER (WHERE o_custkey = 42) AS n_first,
  count(*) FILTER (WHERE o_custkey = 43) AS n_second, CAST(0 AS BIGINT) AS n_shared FROM orders""")
def rls_isolation(t: Tables) -> DataFrame:
    first, second = (S.owned_by(t.orders, "o_custkey", who) for who in (42, 43))
    shared = S.shared_rows(first, second, ["o_orderkey"])
    tagged = (first.select(F.lit("first").alias("who")).unionByName(second.select(F.lit("second").alias("who")))
              .unionByName(shared.select(F.lit("shared").alias("who"))))
    return tagged.agg(*[F.count_if(F.col("who") == w).alias(f"n_{w}") for w in ("first", "second", "shared")])


_GRANTS = """SELECT user_id AS principal, event_type AS object_name,
  CASE WHEN count(*) >= 10 THEN 'ALL' WHEN count(*) >= 6 THEN 'MODIFY' ELSE 'SELECT' END AS privilege"""


@query("effective_access", f"""WITH a AS ({_GRANTS} FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2),
b AS ({_GRANTS} FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2)
SELECT principal, object_name, CASE WHEN 'SELECT' IN (a.privilege, b.privilege) THEN 'SELECT'
  WHEN 'MODIFY' IN (a.privilege, b.privilege) THEN 'MODIFY' ELSE 'ALL' END AS privilege
FROM a JOIN b USING (principal, object_name)""")
def effective_access(t: Tables) -> DataFrame:
    """Grants earned by activity: the first half of the month at catalog level, the second at
    table level."""
    def grants(rows: DataFrame) -> DataFrame:
        n = F.count(F.lit(1))
        return (rows.groupBy(F.col("user_id").alias("principal"), F.col("event_type").alias("object_name"))
                .agg(F.when(n >= 10, "ALL").when(n >= 6, "MODIFY").otherwise("SELECT").alias("privilege")))

    half = stamp("2024-01-15 00:00:00")
    return S.effective_access(grants(t.events.filter(F.col("ts") < half)),
                              grants(t.events.filter(F.col("ts") >= half)))


def _columns(df: DataFrame) -> T.StructType:
    return df.schema


def order_contract(t: Tables) -> C.TableContract:
    return C.TableContract(
        "orders", _columns(t.orders), primary_key=("o_orderkey",), not_null=("o_custkey", "o_orderdate"),
        checks={"price above zero": "o_totalprice > 0", "known status": "o_orderstatus IN ('F', 'O')"},
        foreign_keys=(C.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),))


def line_contract(t: Tables) -> C.TableContract:
    return C.TableContract(
        "lineitem", _columns(t.lineitem), primary_key=("l_orderkey", "l_linenumber"),
        checks={"quantity": "l_quantity > 0 AND l_quantity <= 48"},
        foreign_keys=(C.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),))


def message_contract(t: Tables) -> C.TableContract:
    return C.TableContract("conversations", _columns(t.conversations), primary_key=("conv_id", "turn"),
                           checks={"known role": "role IN ('user', 'assistant', 'tool')"})


def _rule(table: str, rule: str, target: str, sql: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{target}' AS target, {sql}"


@query("contract_violations", "\nUNION ALL\n".join([
    *[_rule("orders", "not_null", c, f"count(*) - count({c}) AS n_violations FROM orders")
      for c in ("o_orderkey", "o_custkey", "o_orderdate")],
    _rule("orders", "check", "price above zero", "count(*) FILTER (WHERE NOT o_totalprice > 0) FROM orders"),
    _rule("orders", "check", "known status", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders"),
    _rule("orders", "unique", "o_orderkey", "count(*) - count(DISTINCT o_orderkey) FROM orders"),
    _rule("orders", "foreign_key", "o_custkey", "count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    *[_rule("lineitem", "not_null", c, f"count(*) - count({c}) FROM lineitem") for c in ("l_orderkey", "l_linenumber")],
    _rule("lineitem", "check", "quantity", "count(*) FILTER (WHERE NOT (l_quantity > 0 AND l_quantity <= 48)) FROM lineitem"),
    _rule("lineitem", "unique", "l_orderkey, l_linenumber", "count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"),
    _rule("lineitem", "foreign_key", "l_orderkey", "count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    *[_rule("conversations", "not_null", c, f"count(*) - count({c}) FROM conversations") for c in ("conv_id", "turn")],
    _rule("conversations", "check", "known role",
          "count(*) FILTER (WHERE role NOT IN ('user', 'assistant', 'tool')) FROM conversations"),
    _rule("conversations", "unique", "conv_id, turn", "count(*) - count(DISTINCT (conv_id, turn)) FROM conversations"),
]))
def contract_violations(t: Tables) -> DataFrame:
    return (C.violations(t.orders, order_contract(t), {"customer": t.customer})
            .unionByName(C.violations(t.lineitem, line_contract(t), {"orders": t.orders}))
            .unionByName(C.violations(t.conversations, message_contract(t))))


@query("pk_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def pk_duplicates(t: Tables) -> DataFrame:
    return C.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("reconcile_counts", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT count(b.o_orderkey) AS n_source, count(a.o_orderkey) AS n_target,
  count(*) FILTER (WHERE a.o_orderkey IS NULL) AS n_missing, count(*) FILTER (WHERE b.o_orderkey IS NULL) AS n_extra,
  count(*) FILTER (WHERE a.o_orderstatus <> b.o_orderstatus) AS n_changed
FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey""")
def reconcile_counts(t: Tables) -> DataFrame:
    return C.reconcile_counts(roles.orders_before(t), roles.orders_after(t), roles.ORDER_KEY)


@query("schema_drift", """SELECT 'c_acctbal' AS column_name, 'retyped' AS drift, count(c_acctbal) AS n_rows_affected FROM customer
UNION ALL SELECT 'c_phone', 'removed', 0
UNION ALL SELECT 'c_mktsegment', 'added', count(c_mktsegment) FROM customer""")
def schema_drift(t: Tables) -> DataFrame:
    declared = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DecimalType(10, 2)),
        T.StructField("c_phone", T.StringType())])
    return C.schema_drift(declared, t.customer)


@query("checklist", """SELECT 'customers loaded' AS check_name, CAST(count(*) AS VARCHAR) AS detail, count(*) >= 1 AS ok FROM customer
UNION ALL SELECT 'every order has a customer', CAST(count(*) AS VARCHAR), count(*) = 0 FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line keys are unique', CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS VARCHAR),
  count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'vectors have 64 values', CAST(count(*) FILTER (WHERE len(embedding) <> 64) AS VARCHAR),
  count(*) FILTER (WHERE len(embedding) <> 64) = 0 FROM embeddings""")
def checklist(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    loaded = t.customer.agg(n.alias("n"))
    lost = C.orphans(t.orders, ["o_custkey"], t.customer, ["c_custkey"]).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    surplus = C.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n"))
    odd = t.embeddings.agg(F.count_if(F.size("embedding") != 64).alias("n"))
    return C.checklist([
        ("customers loaded", loaded, F.col("n"), F.col("n") >= 1),
        ("every order has a customer", lost, F.col("n"), F.col("n") == 0),
        ("line keys are unique", surplus, F.col("n"), F.col("n") == 0),
        ("vectors have 64 values", odd, F.col("n"), F.col("n") == 0)])


def _trees(t: Tables) -> tuple[X.ChecksumTree, X.ChecksumTree]:
    old = X.ChecksumTree.write(roles.orders_before(t), roles.ORDER_KEY, fresh_dir(t.spark, "before"), "before")
    return old, X.ChecksumTree.write(roles.orders_after(t), roles.ORDER_KEY, fresh_dir(t.spark, "after"), "after", like=old)


@query("checksum_differences", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS status
FROM before a FULL JOIN after b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR (a.o_custkey, a.o_orderstatus, a.o_totalprice, a.o_orderdate, a.o_orderpriority)
  IS DISTINCT FROM (b.o_custkey, b.o_orderstatus, b.o_totalprice, b.o_orderdate, b.o_orderpriority)""")
def checksum_differences(t: Tables) -> DataFrame:
    """Both snapshots stored with checksums; only leaves that differ are read again."""
    return X.differences(*_trees(t))


@query("checksum_correction", f"""WITH {roles.SNAPSHOTS_SQL}
SELECT o_orderkey, 'changed' AS status FROM after WHERE o_orderkey = (SELECT max(o_orderkey) FROM after)""")
def checksum_correction(t: Tables) -> DataFrame:
    """The newer snapshot against itself with one order repriced."""
    now = roles.orders_after(t)
    last = now.agg(F.max("o_orderkey")).first()[0]
    fixed = now.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") == F.lit(last), 1).otherwise(0))
    a = X.ChecksumTree.write(now, roles.ORDER_KEY, fresh_dir(t.spark, "now"))
    return X.differences(a, X.ChecksumTree.write(fixed, roles.ORDER_KEY, fresh_dir(t.spark, "fixed"), like=a))
