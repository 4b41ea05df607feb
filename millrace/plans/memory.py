"""Conversation-memory queries over the conversations, events and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import lexemes, parse_importance
from millrace.functions.timing import stamp
from millrace.operators import keyed as K
from millrace.operators import memory as M
from millrace.operators import relational as rel
from millrace.operators import retrieval as R
from millrace.plans import roles
from millrace.plans.registry import query
from millrace.sources.tables import Tables


@query("sessions_from_events", """WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL
    OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 21600000000 THEN 1 ELSE 0 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM s)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS started_at, max(ts) AS ended_at,
  count(*) AS n_events FROM n GROUP BY 1, 2""")
def sessions_from_events(t: Tables) -> DataFrame:
    return K.sessions(t.events, "user_id", "ts", 6 * 3600)


@query("session_bounds", """SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n_messages
FROM conversations GROUP BY 1""")
def session_bounds(t: Tables) -> DataFrame:
    return M.session_bounds(t.conversations, "conv_id", "turn")


@query("recent_messages", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
  FROM conversations)
SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position
FROM r WHERE back <= 4 ORDER BY conv_id, position""")
def recent_messages(t: Tables) -> DataFrame:
    return M.recent_messages(t.conversations, "conv_id", ["turn"], 4)


def _recall_sql(weight: str) -> str:
    return f"""WITH {roles.MEAN_VECTORS_SQL},
mine AS (SELECT query_id AS user_id, doc_id AS episode_id, (doc_id % 10) / 10.0::DOUBLE AS importance,
  1 - list_dot_product(q, d) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(d, d))) AS distance
  FROM asked JOIN stored ON query_id = label),
scored AS (SELECT *, round(distance - importance * {weight}, 9) AS score FROM mine)
SELECT user_id, episode_id, importance, round(distance, 6) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score, episode_id) AS rank FROM scored) WHERE rank <= 5"""


def _recall(t: Tables, weight: float) -> DataFrame:
    """Episodes are the embeddings, their owner is the label; each owner asks with the mean vector."""
    episodes = t.embeddings.select(
        F.col("label").cast("long").alias("user_id"), F.col("vec_id").alias("episode_id"), "embedding",
        (F.col("vec_id") % 10 / F.lit(10.0)).alias("importance"))
    asked = roles.mean_vectors(t).select(F.col("query_id").alias("user_id"), F.col("query_id").alias("request_id"),
                                         F.col("embedding").alias("q"))
    found = M.recall(asked, episodes, "user_id", 5, "request_id", "q", "episode_id", "embedding", "importance", weight)
    return found.select("user_id", "episode_id", "importance", F.round("distance", 6).alias("distance"), "rank")


@query("recall_weighted", _recall_sql("0.1::DOUBLE"))
def recall_weighted(t: Tables) -> DataFrame:
    return _recall(t, 0.1)


@query("recall_plain", _recall_sql("0.0::DOUBLE"))
def recall_plain(t: Tables) -> DataFrame:
    return _recall(t, 0.0)


_TALKS = """talks AS (SELECT conv_id, turn // 1000 AS part,
  string_agg(role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS transcript, count(*) AS n_messages
  FROM conversations GROUP BY 1, 2)"""


def _talks(t: Tables) -> DataFrame:
    return M.transcripts(t.conversations, "conv_id", "turn", "role", "text")


@query("transcripts", f"WITH {_TALKS} SELECT * FROM talks")
def transcripts(t: Tables) -> DataFrame:
    return _talks(t)


def extractive_model(texts: list[str]) -> list[str]:
    """Stand-in summariser: the last line of the transcript, importance by its length."""
    answers = []
    for text in texts:
        answers.append(f"{text.strip().splitlines()[-1] if text.strip() else ''}\n"
                       f"IMPORTANCE: {min(1.0, len(text) / 5000)}")
    return answers


_EPISODES = rf"""{_TALKS}, episodes AS (
SELECT conv_id, regexp_replace(list_extract(string_split(regexp_replace(transcript, '\s+$', ''), chr(10)), -1),
    '^\s+|\s+$', '', 'g') AS summary,
  round(least(1.0::DOUBLE, length(transcript) / 5000.0::DOUBLE), 6) AS importance FROM talks)"""


def _episodes(t: Tables) -> DataFrame:
    found = M.distill_sessions(t.conversations, "conv_id", "turn", "role", "text", extractive_model)
    return found.withColumn("importance", F.round("importance", 6))


@query("distill", f"WITH {_EPISODES} SELECT * FROM episodes")
def distill(t: Tables) -> DataFrame:
    return _episodes(t)


@query("distill_store", f"""WITH {_EPISODES}
SELECT conv_id, c_custkey AS user_id, summary, importance, TIMESTAMP '2024-02-01' AS last_seen, CAST(64 AS BIGINT) AS n_dims
FROM episodes LEFT JOIN customer ON c_custkey = conv_id + 1""")
def distill_store(t: Tables) -> DataFrame:
    """The nightly run twice over: transcript, summary, vector, one stored episode per user and session."""
    owners = t.customer.select((F.col("c_custkey") - 1).alias("conv_id"), F.col("c_custkey").alias("user_id"))
    new = M.episode_rows(_episodes(t), owners, "conv_id", "user_id", stamp("2024-02-01 00:00:00"),
                         lambda df: R.embed_hashed(df.withColumn("tokens", lexemes("summary", "en")), "conv_id", F.col("tokens")))
    stored = new.limit(0)
    for _ in range(2):
        stored = M.remember(stored, new, ["user_id", "conv_id"], ["last_seen"])
    return stored.select("conv_id", "user_id", "summary", "importance", "last_seen", F.size("embedding").cast("long").alias("n_dims"))


@query("parse_importance", r"""SELECT conv_id, turn,
  array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
    lambda x: x <> ''), ' ') AS summary,
  CASE WHEN role = 'assistant' THEN least(1.0::DOUBLE, turn * 0.3::DOUBLE) ELSE 0.5::DOUBLE END AS importance
FROM conversations""")
def parsed(t: Tables) -> DataFrame:
    # Assistant turns end with an importance line (beyond 1 for late turns), the others have none.
    line = F.concat(F.lit("\nImportance: "), (F.col("turn") * 0.3).cast("string"))
    answer = F.concat(F.col("text"), F.when(F.col("role") == "assistant", line).otherwise(F.lit("")))
    summary, importance = parse_importance(answer)
    return t.conversations.select("conv_id", "turn", summary.alias("summary"), importance.alias("importance"))


@query("stale_sessions", f"""WITH {roles.DAY_SESSIONS_SQL}
SELECT user_id, day, started_at FROM day_sessions
WHERE ended_at IS NULL AND started_at < TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR""")
def stale_sessions(t: Tables) -> DataFrame:
    return M.open_sessions_to_close(roles.day_sessions(t), "started_at", "ended_at",
                                    "2024-01-20 00:00:00").drop("ended_at")


@query("close_stale_sessions", f"""WITH {roles.DAY_SESSIONS_SQL}
SELECT user_id, day, started_at, CASE WHEN ended_at IS NULL AND started_at < TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR
  THEN TIMESTAMP '2024-01-20' ELSE ended_at END AS ended_at FROM day_sessions""")
def close_stale_sessions(t: Tables) -> DataFrame:
    return M.close_stale(roles.day_sessions(t), "started_at", "ended_at", "2024-01-20 00:00:00")


@query("recently_ended", f"""WITH {roles.DAY_SESSIONS_SQL}
SELECT user_id, day, ended_at FROM day_sessions WHERE ended_at >= TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR""")
def recently_ended(t: Tables) -> DataFrame:
    return M.recently_ended(roles.day_sessions(t), "ended_at", "2024-01-20 00:00:00").drop("started_at")


@query("prune_episodes", """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS importance,
  ts AS last_seen FROM events)
SELECT * FROM e WHERE CASE WHEN importance >= 0.7 THEN true
  WHEN importance >= 0.3 THEN last_seen >= TIMESTAMP '2024-07-15' - INTERVAL 180 DAY
  ELSE last_seen >= TIMESTAMP '2024-07-15' - INTERVAL 30 DAY END""")
def prune_episodes(t: Tables) -> DataFrame:
    episodes = t.events.select("event_id", (F.get_json_object("props", "$.k").cast("double") / 100).alias("importance"),
                               F.col("ts").alias("last_seen"))
    return M.keep_episodes(episodes, "importance", "last_seen", "2024-07-15 00:00:00")


@query("purge_old", f"""WITH {roles.CALLS_SQL}
SELECT event_id, tool_name, ts FROM calls WHERE ts >= TIMESTAMP '2024-04-10' - INTERVAL 90 DAY""")
def purge_old(t: Tables) -> DataFrame:
    return M.purge_old(roles.calls(t).select("event_id", "tool_name", "ts"), "ts", "2024-04-10 00:00:00")


@query("call_log", """WITH done AS (SELECT l_orderkey, max(l_shipdate) AS ended_at, bool_and(l_returnflag <> 'R') AS ok
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderdate AS started_at, ended_at,
  CAST((epoch_us(ended_at) - epoch_us(o_orderdate)) / 1000 AS BIGINT) AS duration_ms, coalesce(ok, false) AS ok
FROM orders LEFT JOIN done ON l_orderkey = o_orderkey""")
def call_log(t: Tables) -> DataFrame:
    started = t.orders.select("o_orderkey", F.col("o_orderdate").alias("started_at"))
    finished = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
                .agg(F.max("l_shipdate").alias("ended_at"), F.min(F.col("l_returnflag") != "R").alias("fine")))
    return M.call_log(started, finished, "o_orderkey", "started_at", "ended_at", F.col("fine"))


@query("tools_used", """SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
  count(DISTINCT event_type) FILTER (WHERE event_type IN ('view', 'purchase')) AS n_used,
  count(DISTINCT event_type) FILTER (WHERE event_type IN ('view', 'purchase')) = 2 AS all_used
FROM events GROUP BY 1, 2""")
def tools_used(t: Tables) -> DataFrame:
    turns = t.events.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type")
    return rel.tools_used(turns, ["user_id", "day"], "event_type", ["view", "purchase"])


@query("compare_agents", f"""WITH {roles.CALLS_SQL}
SELECT c_mktsegment AS agent_name, tool_name, count(*) AS n_calls, count(*) FILTER (WHERE NOT ok) AS n_failed,
  round(avg(duration_ms), 1) AS avg_ms
FROM calls JOIN customer ON c_custkey = session_id GROUP BY 1, 2""")
def compare_agents(t: Tables) -> DataFrame:
    """The agent version is a property of the session's user."""
    # Calls are summed per session and tool first, so a busy session is a handful of rows.
    summed = roles.calls(t).groupBy("session_id", "tool_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.sum("duration_ms").alias("ms"))
    agents = t.customer.select(F.col("c_custkey").alias("session_id"), F.col("c_mktsegment").alias("agent_name"))
    return (summed.join(agents, "session_id").groupBy("agent_name", "tool_name")
            .agg(F.sum("n").alias("n_calls"), F.sum("bad").alias("n_failed"),
                 F.round(F.sum("ms") / F.sum("n"), 1).alias("avg_ms")))


@query("forget_sessions", """SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (
  SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) <= 3)""")
def forget_sessions(t: Tables) -> DataFrame:
    short = M.session_bounds(t.conversations, "conv_id", "turn").filter(F.col("n_messages") <= 3)
    return M.forget_sessions(t.conversations, short, "conv_id").drop("text")


@query("open_sessions", f"""WITH {roles.DAY_SESSIONS_SQL}, m AS (
  SELECT *, md5(length(CAST(user_id AS VARCHAR)) || ':' || user_id || '|10:' || strftime(day, '%Y-%m-%d') || '|') AS h FROM day_sessions)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
  || substr(h, 21, 12) AS session_id, user_id, 'assistant' AS agent_name, started_at, CAST(NULL AS TIMESTAMP) AS ended_at
FROM m""")
def open_sessions(t: Tables) -> DataFrame:
    asked = roles.day_sessions(t).withColumn("date", F.to_date("day"))
    return M.open_sessions(asked, ["user_id", "date"], "user_id", F.lit("assistant"), "started_at")


@query("add_messages", """WITH top AS (SELECT max(event_id) AS m FROM events)
SELECT m + row_number() OVER (ORDER BY conv_id, turn) AS message_id, conv_id, turn, role FROM conversations, top""")
def add_messages(t: Tables) -> DataFrame:
    log = t.events.select(F.col("event_id").alias("message_id"), F.col("user_id").alias("conv_id"),
                          F.lit(0).cast("long").alias("turn"), F.lit("tool").alias("role"))
    return M.add_messages(log, t.conversations.drop("text"), "message_id", ["conv_id", "turn"])[1]


@query("tool_get_orders", """WITH w AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT user_id FROM events WHERE event_type = 'error')),
r AS (SELECT c_name, o_orderkey, o_totalprice, o_orderdate, row_number() OVER (
  PARTITION BY c_name ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders JOIN w ON o_custkey = c_custkey)
SELECT c_name, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, rank FROM r
WHERE rank <= 5""")
def tool_get_orders(t: Tables) -> DataFrame:
    """Requests name the customers who met an error."""
    names = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    requests = t.events.filter(F.col("event_type") == "error").select(names.alias("c_name"))
    users = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return M.orders_tool(requests, users, orders, "c_name", "o_custkey", "o_orderkey", "o_orderdate").drop("o_custkey")
