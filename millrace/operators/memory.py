"""Conversation-memory jobs: working memory, recall, transcripts, distillation, retention."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.ids import stable_uuid
from millrace.functions.skew import key_set, lookup_join
from millrace.functions.text import parse_importance
from millrace.functions.timing import older_than
from millrace.functions.vectors import distance
from millrace.operators.cdc import append_generated_ids, insert_ignore, update_where
from millrace.operators.keyed import last_n_per_key
from millrace.session import ship_package

ROLES = ("system", "user", "assistant", "tool")


def open_sessions(requests: DataFrame, key: Sequence[str], user: str, agent: Column, started: str) -> DataFrame:
    """Session rows for requests to talk: an id made from the key, user, agent, start, no end."""
    return requests.select(stable_uuid(*key).alias("session_id"), F.col(user).alias("user_id"),
                           agent.alias("agent_name"), F.col(started).alias("started_at"),
                           F.lit(None).cast("timestamp_ntz").alias("ended_at"))


def add_messages(messages: DataFrame, new: DataFrame, id_col: str, order: Sequence[str],
                 role: str = "role") -> tuple[DataFrame, DataFrame]:
    """Append messages with generated ids. Returns (all messages, new rows).

    A role outside :data:`ROLES` raises when the row is computed.
    """
    known = F.when(F.col(role).isin(*ROLES), F.col(role)).otherwise(
        F.raise_error(F.concat(F.lit("unknown role: "), F.coalesce(F.col(role), F.lit("NULL")))))
    return append_generated_ids(messages, new.withColumn(role, known), id_col, order)


def orders_tool(requests: DataFrame, users: DataFrame, orders: DataFrame, natural: str, user: str,
                order_key: str, placed: str, n: int = 5) -> DataFrame:
    """Last ``n`` orders of every user asked for by natural key, times as ISO text."""
    wanted = users.join(key_set(requests, [natural]), [natural], "left_semi").select(user, natural)
    mine = lookup_join(orders, wanted, [user])
    ranked = last_n_per_key(mine, [natural], [F.col(placed).desc(), F.col(order_key).desc()], n, rank_as="rank")
    return ranked.withColumn(placed, F.date_format(placed, "yyyy-MM-dd'T'HH:mm:ss"))


def session_bounds(messages: DataFrame, session: str, order: str) -> DataFrame:
    """First and last message position and message count per session."""
    return messages.groupBy(session).agg(F.min(order).alias("first_" + order),
                                         F.max(order).alias("last_" + order),
                                         F.count(F.lit(1)).alias("n_messages"))


def recent_messages(messages: DataFrame, session: str, order: Sequence[str], n: int = 20) -> DataFrame:
    """Last ``n`` messages per session with ``position`` counting oldest first."""
    ranked = last_n_per_key(messages, [session], [F.col(c).desc() for c in order], n, rank_as="_back")
    # At most n rows per session are left, so counting them again needs no further shuffle.
    kept = F.max("_back").over(Window.partitionBy(session))
    return (ranked.withColumn("position", kept - F.col("_back") + 1).drop("_back")
            .orderBy(session, "position"))


def recall(requests: DataFrame, episodes: DataFrame, user: str, k: int, request_id: str,
           request_vec: str, episode_id: str, vec: str, importance: str | None = None,
           weight: float = 0.1, digits: int = 9) -> DataFrame:
    """Best ``k`` episodes of the asking user per request, by distance minus weighted importance.

    Requests meet only their user's own episodes, and each task keeps its best ``k`` per request
    before anything is shuffled. With ``weight=0`` (or no ``importance``) the order is plain
    distance. Requests and episodes without a vector, or with a zero vector, have no rank.
    """
    asked = requests.select(user, F.col(request_id), F.col(request_vec).alias("_asked"))
    pairs = lookup_join(episodes, asked, [user]).withColumn("distance", distance(vec, "_asked"))
    bonus = F.lit(0.0) if importance is None else F.col(importance).cast("double") * F.lit(weight)
    scored = pairs.withColumn("score", F.round(F.col("distance") - bonus, digits)).drop("_asked", vec)
    scored = scored.filter(F.col("score").isNotNull() & ~F.isnan("score"))
    return last_n_per_key(scored, [user, request_id], ["score", episode_id], k, rank_as="rank")


def transcripts(messages: DataFrame, session: str, turn: str, role: str, content: str,
                part_turns: int = 1000) -> DataFrame:
    """``role: content`` lines per session in turn order.

    Sessions longer than ``part_turns`` turns come in numbered parts, so no task ever gathers an
    unbounded session; parts in order are the whole transcript.
    """
    line = F.concat(F.col(role), F.lit(": "), F.coalesce(F.col(content), F.lit("")))
    return (messages.withColumn("part", F.floor(F.col(turn) / F.lit(part_turns)).cast("long"))
            .groupBy(session, "part")
            .agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), line.alias("l"))))
                 .alias("_lines"))
            .select(session, "part", F.array_join("_lines.l", "\n").alias("transcript"),
                    F.size("_lines").cast("long").alias("n_messages")))


def open_sessions_to_close(sessions: DataFrame, started: str, ended: str, now: str,
                           hours: int = 24) -> DataFrame:
    """Sessions that never ended and started more than ``hours`` ago."""
    return sessions.filter(F.col(ended).isNull() & older_than(started, now, hours=hours))


def recently_ended(sessions: DataFrame, ended: str, now: str, hours: int = 24) -> DataFrame:
    """Sessions that ended within the last ``hours``."""
    return sessions.filter(~older_than(ended, now, hours=hours))


def close_stale(sessions: DataFrame, started: str, ended: str, now: str, hours: int = 24) -> DataFrame:
    """Mark stale open sessions as ended at ``now``."""
    stale = F.col(ended).isNull() & older_than(started, now, hours=hours)
    return update_where(sessions, stale, **{ended: F.lit(now).cast("timestamp_ntz")})


def distill(talks: DataFrame, session: str, text: str, model: Callable[[list[str]], list[str]],
            batch: int = 16) -> DataFrame:
    """Run transcripts through an injected summariser and parse its answer.

    The model gets lists of texts and returns as many answers, each with a summary and a line
    ``IMPORTANCE: x``.
    """
    ship_package(talks.sparkSession)
    kind = talks.schema[session].dataType.simpleString()
    extra = ["part"] if "part" in talks.columns else []

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                piece = frame.iloc[start:start + batch]
                answers = model([t or "" for t in piece[text]])
                if len(answers) != len(piece):
                    raise ValueError(f"model gave {len(answers)} answers for {len(piece)} texts")
                yield piece.drop(columns=[text]).assign(answer=answers)

    schema = ", ".join([f"{session} {kind}", *[f"{c} long" for c in extra], "answer string"])
    answered = talks.select(session, *extra, text).mapInPandas(run, schema)
    summary, importance = parse_importance("answer")
    return answered.select(session, *extra, summary.alias("summary"), importance.alias("importance"))


def distill_sessions(messages: DataFrame, session: str, turn: str, role: str, content: str,
                     model: Callable[[list[str]], list[str]], part_turns: int = 1000, batch: int = 16) -> DataFrame:
    """One episode per session, whatever its length: session, summary, importance.

    A session of up to ``part_turns`` turns is summarised at once. Of a longer one the parts are
    summarised, and then their summaries, in order, are.
    """
    talks = transcripts(messages, session, turn, role, content, part_turns)
    parts = (distill(talks, session, "transcript", model, batch).groupBy(session)
             .agg(F.sort_array(F.collect_list(F.struct("part", "summary", "importance"))).alias("_parts")))
    first = F.col("_parts")[0]
    whole = parts.filter(F.size("_parts") == 1).select(session, first["summary"].alias("summary"), first["importance"].alias("importance"))
    longer = parts.filter(F.size("_parts") > 1).select(session, F.array_join("_parts.summary", "\n").alias("_text"))
    return whole.unionByName(distill(longer, session, "_text", model, batch))


def episode_rows(distilled: DataFrame, owners: DataFrame, session: str, user: str, seen: Column,
                 embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Distilled sessions as rows of the episode table: session, user, summary, importance, last_seen, embedding.

    ``embed`` takes (session, summary) and returns (session, embedding); ``owners`` names the user of a session.
    """
    rows = lookup_join(distilled, owners.select(session, user), [session], "left").withColumn("last_seen", seen)
    return rows.join(embed(distilled.select(session, "summary")), session)


def remember(episodes: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add episodes once per key, so repeating the nightly run changes nothing."""
    return insert_ignore(episodes, new, keys, order)


def keep_episodes(episodes: DataFrame, importance: str, last_seen: str, now: str) -> DataFrame:
    """Retention by importance: from 0.7 for ever, from 0.3 for 180 days, below for 30 days.
    Episodes of unknown age stay."""
    score = F.coalesce(F.col(importance), F.lit(0.5))
    expired = F.when(score >= 0.7, F.lit(False)).when(score >= 0.3, older_than(last_seen, now, days=180)).otherwise(
        older_than(last_seen, now, days=30))
    return episodes.filter(~F.coalesce(expired, F.lit(False)))


def purge_old(rows: DataFrame, ts: str, now: str, days: int = 90) -> DataFrame:
    """Drop rows older than ``days``; rows without a time stay."""
    return rows.filter(~F.coalesce(older_than(ts, now, days=days), F.lit(False)))


def call_log(started: DataFrame, finished: DataFrame, key: str, start_ts: str, end_ts: str,
             ok: Column) -> DataFrame:
    """Call rows with duration in ms and success; calls that never finished count as failed."""
    done = finished.select(key, end_ts, ok.alias("ok"))
    took = (F.unix_micros(F.col(end_ts).cast("timestamp"))
            - F.unix_micros(F.col(start_ts).cast("timestamp"))) / F.lit(1000)
    return (lookup_join(started, done, [key], "left")
            .withColumn("duration_ms", took.cast("long"))
            .withColumn("ok", F.coalesce("ok", F.lit(False))))


def forget_sessions(messages: DataFrame, doomed: DataFrame, session: str) -> DataFrame:
    """Messages without those of the listed sessions (call logs are kept on purpose)."""
    return lookup_join(messages, key_set(doomed, [session]), [session], "left_anti")
