"""The roles the given tables play: call log, sessions, change log, snapshots, questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.skew import settle, spread
from millrace.functions.text import lexemes
from millrace.functions.timing import stamp
from millrace.operators import retrieval as R
from millrace.operators.keywords import KeywordIndex
from millrace.operators.variants import VariantStore
from millrace.session import fresh_dir
from millrace.sources.tables import Tables, content_stamp

CUTOFF = "2001-01-01 00:00:00"
ORDER_KEY = ["o_orderkey"]


def calls(t: Tables) -> DataFrame:
    """Call log: one row per event, the event type is the tool, errors are the failed calls."""
    e = t.events
    return e.select("event_id", F.col("user_id").alias("session_id"),
                    F.col("event_type").alias("tool_name"), F.col("props").alias("args"),
                    (F.col("value") * 10).alias("duration_ms"),
                    (F.col("event_type") != "error").alias("ok"), "ts")


CALLS_SQL = """calls AS (
  SELECT event_id, user_id AS session_id, event_type AS tool_name, props AS args,
         value * 10 AS duration_ms, event_type <> 'error' AS ok, ts FROM events)"""


def day_sessions(t: Tables) -> DataFrame:
    """A session per user and day; it has ended if the user purchased something."""
    e = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return e.groupBy("user_id", "day").agg(
        F.min("ts").alias("started_at"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("ended_at"))


DAY_SESSIONS_SQL = """day_sessions AS (
  SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, min(ts) AS started_at,
         max(ts) FILTER (WHERE event_type = 'purchase') AS ended_at
  FROM events GROUP BY 1, 2)"""


def orders_before(t: Tables) -> DataFrame:
    """Older snapshot of the orders."""
    return t.orders.filter(F.col("o_orderdate") < stamp(CUTOFF))


def orders_after(t: Tables) -> DataFrame:
    """Newer snapshot: low-priority finished orders are gone, open ones are in progress, and
    orders since the cutoff have appeared."""
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    return t.orders.filter(~gone).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "P").otherwise(F.col("o_orderstatus")))


SNAPSHOTS_SQL = """before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
after AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'P' ELSE o_orderstatus END
         AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))"""


def price_corrections(t: Tables) -> DataFrame:
    """Source of the merges: open orders and all orders since the cutoff, 100 dearer."""
    return (t.orders.filter((F.col("o_orderstatus") != "F") | (F.col("o_orderdate") >= stamp(CUTOFF)))
            .withColumn("o_totalprice", F.col("o_totalprice") + 100))


CORRECTIONS_SQL = """before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '2001-01-01')"""


def order_history(t: Tables) -> DataFrame:
    """Change history of the orders, from one scan.

    Every order is inserted on its date; open ones are finished and repriced a month later;
    finished low-priority ones are deleted after two months; urgent ones also receive an update
    that was committed a day before the insert, so it arrives out of order.
    """
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    finished_low = (status == "F") & (F.col("o_orderpriority") == "5-LOW")
    kinds = F.array_compact(F.array(
        F.lit(0), F.when(status.isin("O", "P"), 1), F.when(finished_low, 2),
        F.when(F.col("o_orderpriority") == "1-URGENT", 3)))
    kind = F.col("_kind")

    def by_kind(*values: Column) -> Column:
        out = F.when(kind == 0, values[0])
        for i, value in enumerate(values[1:], 1):
            out = out.when(kind == i, value)
        return out

    days = by_kind(*[F.make_interval(days=F.lit(n)) for n in (0, 30, 60, -1)])
    return t.orders.withColumn("_kind", F.explode(kinds)).select(
        "o_orderkey", "o_custkey", by_kind(status, F.lit("F"), status, F.lit("X")).alias("o_orderstatus"),
        by_kind(price, price + 100, price, price).alias("o_totalprice"), "o_orderdate", "o_orderpriority",
        by_kind(*map(F.lit, ("insert", "update", "delete", "update"))).alias("_change_type"),
        (F.col("o_orderdate") + days).alias("_commit_timestamp"))


HISTORY_SQL = """history AS (
  SELECT *, 'insert' AS _change_type, o_orderdate AS _commit_timestamp FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'F', o_totalprice + 100, o_orderdate, o_orderpriority, 'update',
         o_orderdate + INTERVAL 30 DAY FROM orders WHERE o_orderstatus IN ('O', 'P')
  UNION ALL
  SELECT *, 'delete', o_orderdate + INTERVAL 60 DAY FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, o_custkey, 'X', o_totalprice, o_orderdate, o_orderpriority, 'update',
         o_orderdate - INTERVAL 1 DAY FROM orders WHERE o_orderpriority = '1-URGENT')"""


def mean_vectors(t: Tables) -> DataFrame:
    """One question vector per label: the mean of its embeddings."""
    return settle(R.mean_vectors(t.embeddings, "label").withColumnRenamed("label", "query_id"))


MEAN_VECTORS_SQL = """dims AS (
  SELECT label, vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x
  FROM embeddings),
means AS (
  SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM dims GROUP BY 1, 2),
asked AS (
  SELECT CAST(label AS BIGINT) AS query_id,
         CAST(list(CAST(m AS FLOAT) ORDER BY pos) AS DOUBLE[]) AS q
  FROM means GROUP BY label),
stored AS (
  SELECT vec_id AS doc_id, label, CAST(embedding AS DOUBLE[]) AS d FROM embeddings),
pairs AS (
  SELECT query_id, doc_id, label,
         round(1 - list_dot_product(q, d) / (sqrt(list_dot_product(q, q))
               * sqrt(list_dot_product(d, d))), 9) AS distance
  FROM asked, stored)"""


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.withColumnRenamed("vec_id", "doc_id")


def doc_tokens(t: Tables) -> DataFrame:
    """Documents with their lexemes, language by language."""
    return with_tokens(t.documents)


def with_tokens(docs: DataFrame) -> DataFrame:
    return spread(docs, "doc_id").withColumn("tokens", lexemes("text", F.col("lang")))


_STORED: dict[tuple, str] = {}


def _stored(t: Tables, label: str, write, table: str = "documents") -> str:
    """Folder that ``write`` has filled for ``table`` as it is now; filled once per application.

    A changed, added or removed file of the table makes it a different one.
    """
    name = (t.spark.sparkContext.applicationId, label, t.folder, content_stamp(getattr(t, table)))
    if name not in _STORED:
        root = fresh_dir(t.spark, label)
        write(root)
        _STORED[name] = root
    return _STORED[name]


def library(t: Tables) -> DataFrame:
    """The analysed documents as stored: their columns but the text, vector, and lexemes joined by one space.

    One string per document passes Python, files and scans far more cheaply than a list of as many as there are lexemes.
    """
    def write(root: str) -> None:
        docs = doc_tokens(t).drop("text").withColumn("tokens", F.array_join("tokens", " "))
        R.embed_hashed(docs, "doc_id", F.col("tokens"), keep=[c for c in docs.columns if c != "doc_id"]).write.parquet(root)

    return t.spark.read.parquet(_stored(t, "library", write))


def keyword_index(t: Tables) -> KeywordIndex:
    """The stored inverted index of the documents."""
    return KeywordIndex.open(t.spark, _stored(t, "keyword-index", lambda root: KeywordIndex.build(library(t), root)))


def call_arguments(t: Tables) -> VariantStore:
    """The events with their properties stored as variants."""
    return VariantStore.open(t.spark, _stored(t, "call-arguments", lambda root: VariantStore.write(t.events, "props", root), "events"))


def document_cards(t: Tables) -> VariantStore:
    """A JSON card per document: language and source, once as members and once as a list of tags."""
    def write(root: str) -> None:
        tags = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("lang", "source")])
        card = F.struct("source", F.struct("lang", "n_chars").alias("meta"), tags.alias("tags"))
        VariantStore.write(t.documents.select("doc_id", F.to_json(card).alias("card")), "card", root)

    return VariantStore.open(t.spark, _stored(t, "document-cards", write))


def questions(t: Tables) -> DataFrame:
    """Question texts with their lexemes."""
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text",
                              lexemes("text", "en").alias("tokens"))


def question_words(t: Tables) -> DataFrame:
    return R.question_terms(questions(t), "query_id", F.col("tokens"))


def doc_vectors(t: Tables, where: Column | None = None) -> DataFrame:
    docs = doc_tokens(t) if where is None else with_tokens(t.documents.filter(where))
    return R.embed_hashed(docs, "doc_id", F.col("tokens"))


def question_vectors(t: Tables) -> DataFrame:
    return R.embed_hashed(questions(t), "query_id", F.col("tokens"))


def _lexeme_sql(text: str, lang: str | None) -> str:
    """DuckDB list expression for the lexeme rules, token by token."""
    from millrace.functions.text import ENDINGS, SHORTEST_STEM, STOP_WORDS

    words = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"

    def kept(code: str) -> str:
        stop = ", ".join(f"'{w}'" for w in STOP_WORDS[code])
        return f"list_filter({words}, lambda w: w NOT IN ({stop}))"

    stem = "^([\\p{L}\\p{N}]{%d,}?)(?:%s)$" % (SHORTEST_STEM, "|".join(ENDINGS))
    english = f"list_transform({kept('en')}, lambda w: regexp_replace(w, '{stem}', '\\1'))"
    if lang is None:
        return english
    others = " ".join(f"WHEN '{c}' THEN {kept(c)}" for c in STOP_WORDS if c != "en")
    return f"CASE {lang} WHEN 'en' THEN {english} {others} ELSE {words} END"


#: Tokens of documents and questions, one row per occurrence.
TOKENS_SQL = f"""doc_lists AS (
  SELECT doc_id, text, lang, source, n_chars, {_lexeme_sql('text', 'lang')} AS tokens
  FROM documents),
ask_lists AS (
  SELECT item_id AS query_id, {_lexeme_sql('text', None)} AS tokens FROM benchmark),
doc_words AS (SELECT doc_id, unnest(tokens) AS term FROM doc_lists),
ask_words AS (SELECT query_id, unnest(tokens) AS term FROM ask_lists),
ask_terms AS (SELECT DISTINCT query_id, term FROM ask_words),
doc_terms AS (SELECT doc_id, term, count(*) AS tf FROM doc_words GROUP BY 1, 2)"""


def hashed_sql(words: str, key: str) -> str:
    return f"""SELECT {key}, CAST(('0x' || substr(md5(term), 1, 8)) AS UBIGINT) % 64 AS bucket,
         CAST(sum(CASE WHEN CAST(('0x' || substr(md5(term), 9, 1)) AS UBIGINT) % 2 = 0
                  THEN 1 ELSE -1 END) AS DOUBLE) AS w
  FROM {words} GROUP BY 1, 2"""


#: Cosine distance of every question to every document over the hashed features.
HASHED_PAIRS_SQL = f"""dv AS ({hashed_sql('doc_words', 'doc_id')}),
av AS ({hashed_sql('ask_words', 'query_id')}),
dn AS (SELECT doc_id, sum(w * w) AS s FROM dv GROUP BY 1 HAVING sum(w * w) > 0),
an AS (SELECT query_id, sum(w * w) AS s FROM av GROUP BY 1 HAVING sum(w * w) > 0),
dots AS (
  SELECT query_id, doc_id, sum(av.w * dv.w) AS dot FROM av JOIN dv USING (bucket) GROUP BY 1, 2),
hashed_pairs AS (
  SELECT an.query_id, dn.doc_id,
         round(1 - coalesce(dot, 0) / (sqrt(an.s) * sqrt(dn.s)), 9) AS distance
  FROM an CROSS JOIN dn LEFT JOIN dots USING (query_id, doc_id))"""


#: Documents holding every lexeme of a question, with the frequency score.
MATCHES_SQL = """wanted AS (SELECT query_id, count(*) AS n FROM ask_terms GROUP BY 1),
matches AS (
  SELECT a.query_id, d.doc_id, round(sum(1 + ln(d.tf)), 9) AS score
  FROM ask_terms a JOIN doc_terms d USING (term) JOIN wanted w ON w.query_id = a.query_id
  GROUP BY 1, 2, w.n HAVING count(*) = w.n)"""

#: BM25 of every document sharing a lexeme with a question.
BM25_SQL = """lens AS (SELECT doc_id, len(tokens) AS dl FROM doc_lists),
avglen AS (SELECT avg(dl) AS mean, count(*) AS n FROM lens),
dfs AS (SELECT term, count(*) AS df FROM doc_terms GROUP BY 1),
bm AS (
  SELECT a.query_id, d.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 9) AS score
  FROM ask_terms a JOIN doc_terms d USING (term) JOIN dfs USING (term)
       JOIN lens l ON l.doc_id = d.doc_id, avglen
  GROUP BY 1, 2)"""
