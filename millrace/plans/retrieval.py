"""Text and vector queries: questions come from the benchmark texts or the label means."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.skew import key_set, lookup_join, settle, spread
from millrace.functions.text import chunks, word_chunks
from millrace.functions.vectors import distance
from millrace.operators import retrieval as R
from millrace.operators.compressed import PqIndex, depth_for, knn_pq
from millrace.operators.keywords import KeywordIndex
from millrace.operators.security import assigned_rows
from millrace.plans import roles
from millrace.plans.registry import query
from millrace.session import fresh_dir
from millrace.sources.tables import Tables, VersionedTable


@query("tokenize", f"""WITH {roles.TOKENS_SQL}
SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_lexemes, CAST(len(list_distinct(tokens)) AS BIGINT) AS n_distinct,
  md5(array_to_string(tokens, ' ')) AS digest FROM doc_lists""")
def tokenize(t: Tables) -> DataFrame:
    return roles.doc_tokens(t).select(
        "doc_id", F.size("tokens").cast("long").alias("n_lexemes"),
        F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"),
        F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("postings", f"WITH {roles.TOKENS_SQL} SELECT term, doc_id, tf FROM doc_terms")
def postings(t: Tables) -> DataFrame:
    return roles.keyword_index(t).postings()


@query("index_build", f"""WITH {roles.TOKENS_SQL}
SELECT (SELECT count(*) FROM documents) AS n_documents, count(DISTINCT term) AS n_terms, count(*) AS n_postings,
  CAST(sum(tf) AS BIGINT) AS n_occurrences FROM doc_terms""")
def index_build(t: Tables) -> DataFrame:
    """Writes an index anew and counts what is in it."""
    index = KeywordIndex.build(roles.library(t), fresh_dir(t.spark, "keyword-index"))
    terms = index.terms.agg(F.count(F.lit(1)).alias("n_terms"))
    occurrences = F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x))
    postings = index.blocks.agg(F.sum(F.size("docs")).alias("n_postings"), occurrences.alias("n_occurrences"))
    return (terms.unionByName(postings, allowMissingColumns=True)
            .agg(F.lit(index.documents).alias("n_documents"), *(F.max(c).alias(c) for c in ("n_terms", "n_postings", "n_occurrences"))))


@query("chunk_documents", r"""WITH d AS (
  SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM documents),
w AS (SELECT doc_id, body, length(body) AS size, unnest(CASE WHEN length(body) <= 1800 THEN [0]
      ELSE range(0, length(body), 1600) END) AS pos FROM d),
c AS (SELECT doc_id, pos, substr(body, pos + 1, 1800) AS chunk FROM w)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS chunk_index,
  CAST(length(chunk) AS BIGINT) AS n_chars, md5(chunk) AS digest
FROM c WHERE regexp_matches(chunk, '\S')""")
def chunk_documents(t: Tables) -> DataFrame:
    return (spread(t.documents.select("doc_id", "text"), "doc_id").select("doc_id", F.posexplode(chunks("text")).alias("chunk_index", "chunk"))
            .select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"),
                    F.length("chunk").cast("long").alias("n_chars"), F.md5("chunk").alias("digest")))


@query("chunk_by_words", r"""WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, words, unnest(range(1, greatest(len(words), 1) + 1, 450)) AS pos FROM d),
c AS (SELECT doc_id, pos, list_slice(words, pos, pos + 499) AS part FROM w)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS chunk_index, CAST(len(part) AS BIGINT) AS n_words,
  md5(array_to_string(part, ' ')) AS digest FROM c WHERE len(part) > 0""")
def chunk_by_words(t: Tables) -> DataFrame:
    parts = spread(t.documents.select("doc_id", "text"), "doc_id").select(
        "doc_id", F.posexplode(word_chunks("text")).alias("chunk_index", "chunk"))
    return parts.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"),
                        F.size(F.split("chunk", " ")).cast("long").alias("n_words"), F.md5("chunk").alias("digest"))


@query("embed_hash", f"""WITH {roles.TOKENS_SQL}, dv AS ({roles.hashed_sql('doc_words', 'doc_id')}),
grid AS (SELECT doc_id, unnest(range(64)) AS bucket FROM documents)
SELECT doc_id, array_to_string(list(CAST(coalesce(w, 0) AS INTEGER) ORDER BY bucket), ',') AS vector
FROM grid LEFT JOIN dv USING (doc_id, bucket) GROUP BY 1""")
def embed_hash(t: Tables) -> DataFrame:
    return roles.doc_vectors(t).select(
        "doc_id", F.array_join(F.col("embedding").cast("array<int>"), ",").alias("vector"))


@query("vector_distances", f"""WITH {roles.MEAN_VECTORS_SQL}
SELECT doc_id, query_id, round(1 - list_dot_product(q, d) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(d, d))), 6) AS cosine,
  round(sqrt(list_dot_product(q, q) - 2 * list_dot_product(q, d) + list_dot_product(d, d)), 6) AS l2,
  round(-list_dot_product(q, d), 6) AS negative_inner_product
FROM asked JOIN stored ON query_id = label""")
def vector_distances(t: Tables) -> DataFrame:
    mean = roles.mean_vectors(t).select(F.col("query_id").cast("int").alias("label"), "query_id",
                                        F.col("embedding").alias("q"))
    pairs = lookup_join(roles.vectors(t), mean, ["label"])
    return pairs.select("doc_id", "query_id",
                        F.round(distance("embedding", "q", "cosine"), 6).alias("cosine"),
                        F.round(distance("embedding", "q", "l2"), 6).alias("l2"),
                        F.round(distance("embedding", "q", "negative_inner_product"), 6)
                        .alias("negative_inner_product"))


def _nearest_sql(condition: str, k: int) -> str:
    return f"""WITH {roles.MEAN_VECTORS_SQL}
SELECT query_id, doc_id, round(distance, 6) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank
  FROM pairs WHERE {condition}) WHERE rank <= {k}"""


def _shown(hits: DataFrame) -> DataFrame:
    return hits.withColumn("distance", F.round("distance", 6))


@query("knn_exact", _nearest_sql("true", 10))
def knn_exact(t: Tables) -> DataFrame:
    return _shown(R.knn_exact(roles.mean_vectors(t), roles.vectors(t), 10))


@query("knn_filtered", _nearest_sql("label IN (1, 3, 5, 7, 9)", 10))
def knn_filtered(t: Tables) -> DataFrame:
    return _shown(R.knn_exact(roles.mean_vectors(t), roles.vectors(t), 10,
                              where=F.col("label").isin(1, 3, 5, 7, 9)))


@query("knn_ivf_all_cells", _nearest_sql("true", 10))
def knn_ivf_all_cells(t: Tables) -> DataFrame:
    index = R.ivf_build(roles.vectors(t), cells=16).save(fresh_dir(t.spark, "ivf"))
    return _shown(R.knn_ivf(roles.mean_vectors(t), index, 10, nprobe=16))


@query("knn_ivf", f"""WITH {roles.MEAN_VECTORS_SQL},
placed AS (SELECT doc_id, query_id AS cell FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, query_id) AS r FROM pairs) WHERE r = 1),
probed AS (SELECT query_id, cell FROM (
  SELECT a.query_id, b.query_id AS cell, row_number() OVER (PARTITION BY a.query_id ORDER BY
      1 - list_dot_product(a.q, b.q) / (sqrt(list_dot_product(a.q, a.q)) * sqrt(list_dot_product(b.q, b.q))), b.query_id) AS r
  FROM asked a, asked b) WHERE r <= 4)
SELECT query_id, doc_id, round(distance, 6) AS distance, rank FROM (
  SELECT p.*, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank
  FROM pairs p JOIN placed USING (doc_id) JOIN probed USING (query_id, cell)) WHERE rank <= 10""")
def knn_ivf(t: Tables) -> DataFrame:
    """A stored index whose centres are the label means; each question looks into four cells."""
    asked = roles.mean_vectors(t)
    centres = np.array([r.embedding for r in asked.orderBy("query_id").collect()], float)  # one per label
    index = R.ivf_build(roles.vectors(t), cells=len(centres), centres=centres).save(fresh_dir(t.spark, "ivf"))
    return _shown(R.knn_ivf(asked, index, 10, nprobe=4))


@query("knn_ivf_recall")
def knn_ivf_recall(t: Tables) -> DataFrame:
    """Recall of a k-means index with about the square root of the rows as cells, probed until nine in ten are found."""
    rows = roles.vectors(t)
    cells = max(2, int(rows.count() ** 0.5))
    index = R.ivf_build(rows, cells).save(fresh_dir(t.spark, "ivf"))
    asked = roles.mean_vectors(t)
    exact = settle(R.knn_exact(asked, rows, 10))
    found = R.knn_ivf(asked, index, 10, nprobe=R.probes_for(asked, index, exact, 10))
    return R.recall_against(found, exact)


@query("knn_pq_recall")
def knn_pq_recall(t: Tables) -> DataFrame:
    """Recall of the compressed index for every vector whose id is divisible by 100, at the least depth that finds nine in ten."""
    rows = roles.vectors(t)
    index = PqIndex.build(rows, fresh_dir(t.spark, "pq"), parts=16)
    asked = settle(rows.filter(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "embedding"))
    exact = settle(R.knn_exact(asked, rows, 10))
    return R.recall_against(knn_pq(asked, index, 10, depth_for(asked, index, exact, 10)), exact)


@query("keyword_match", f"""WITH {roles.TOKENS_SQL}, {roles.MATCHES_SQL}
SELECT query_id, doc_id FROM matches""")
def keyword_match(t: Tables) -> DataFrame:
    return roles.keyword_index(t).match(roles.question_words(t)).select("query_id", "doc_id")


@query("keyword_rank", f"""WITH {roles.TOKENS_SQL}, {roles.MATCHES_SQL}
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM matches)
WHERE rank <= 10""")
def keyword_rank(t: Tables) -> DataFrame:
    return roles.keyword_index(t).match(roles.question_words(t), k=10).withColumn("score", F.round("score", 6))


@query("bm25_topk", f"""WITH {roles.TOKENS_SQL}, {roles.BM25_SQL}
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM bm)
WHERE rank <= 10""")
def bm25_topk(t: Tables) -> DataFrame:
    return roles.keyword_index(t).bm25(roles.question_words(t), 10).withColumn("score", F.round("score", 6))


def _legs_sql(condition: str, leg: int) -> str:
    return f"""vec AS (SELECT * FROM (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank
  FROM hashed_pairs JOIN doc_lists USING (doc_id) WHERE {condition}) WHERE rank <= {leg}),
key AS (SELECT * FROM (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM matches JOIN doc_lists USING (doc_id) WHERE {condition}) WHERE rank <= {leg})"""


def _rrf_join_sql(condition: str, leg: int, k: int) -> str:
    return f"""WITH {roles.TOKENS_SQL}, {roles.HASHED_PAIRS_SQL}, {roles.MATCHES_SQL},
{_legs_sql(condition, leg)},
fused AS (
  SELECT query_id, doc_id, vec.rank AS vec_rank, key.rank AS key_rank,
         coalesce(1::DOUBLE / (60 + vec.rank), 0) + coalesce(1::DOUBLE / (60 + key.rank), 0) AS rrf
  FROM vec FULL JOIN key USING (query_id, doc_id))
SELECT query_id, doc_id, vec_rank, key_rank, round(rrf, 6) AS rrf, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, doc_id) AS rank FROM fused)
WHERE rank <= {k}"""


def _hybrid(t: Tables, leg: int, k: int, docs: DataFrame | None = None) -> DataFrame:
    """Both legs over all documents or the filtered ``docs`` of the library, fused by the join form."""
    near = R.knn_exact(roles.question_vectors(t), roles.library(t) if docs is None else docs, leg)
    worded = roles.keyword_index(t).match(roles.question_words(t), k=leg, allowed=docs)
    return R.rrf_join(near, worded, k).withColumn("rrf", F.round("rrf", 6))


@query("rrf_join", _rrf_join_sql("true", 50, 10))
def rrf_join(t: Tables) -> DataFrame:
    return _hybrid(t, 50, 10)


@query("rrf_filtered", _rrf_join_sql("lang = 'en' AND n_chars >= 200", 50, 10))
def rrf_filtered(t: Tables) -> DataFrame:
    return _hybrid(t, 50, 10, roles.library(t).filter((F.col("lang") == "en") & (F.col("n_chars") >= 200)))


_SECURED = """lang = 'en' AND n_chars >= 200
  AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
  AND source IN (SELECT d.source FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1)"""


@query("hybrid_secured", _rrf_join_sql(_SECURED, 50, 10))
def hybrid_secured(t: Tables) -> DataFrame:
    """Tenant, stock and quality predicates plus a row policy, all before ranking.

    The reviewer is assigned every source that has a document labelled toxic.
    """
    toxic = t.labels.filter(F.col("toxic") == 1).select("doc_id")
    assigned = (t.documents.select("doc_id", "source").join(toxic, "doc_id", "left_semi")
                .select(F.lit("reviewer").alias("principal"), "source").distinct())
    good = t.labels.filter(F.col("quality") == 1)
    docs = roles.library(t).filter((F.col("lang") == "en") & (F.col("n_chars") >= 200))
    docs = assigned_rows(docs, assigned, "reviewer", ["source"]).join(key_set(good, ["doc_id"]), "doc_id", "left_semi")
    return _hybrid(t, 50, 10, docs)


_UNION_SQL = f"""{roles.TOKENS_SQL}, {roles.HASHED_PAIRS_SQL}, {roles.BM25_SQL},
stacked AS (
  SELECT query_id, doc_id, rank FROM (
    SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank
    FROM hashed_pairs) WHERE rank <= 20
  UNION ALL
  SELECT query_id, doc_id, rank FROM (
    SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
    FROM bm) WHERE rank <= 20),
fused AS (SELECT query_id, doc_id, sum(1::DOUBLE / (60 + rank)) AS rrf FROM stacked GROUP BY 1, 2),
hits AS (SELECT * FROM (
  SELECT query_id, doc_id, rrf, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, doc_id) AS rank FROM fused)
  WHERE rank <= 5)"""


def hybrid_hits(t: Tables, k: int = 5) -> DataFrame:
    """Hybrid search of all questions over all documents: cosine leg plus BM25 leg, fused."""
    leg = R.leg_size(k)
    near = R.knn_exact(roles.question_vectors(t), roles.library(t), leg)
    worded = roles.keyword_index(t).bm25(roles.question_words(t), leg)
    return R.rrf_union([near, worded], k)


@query("rrf_union", f"WITH {_UNION_SQL} SELECT query_id, doc_id, round(rrf, 6) AS rrf, rank FROM hits")
def rrf_union(t: Tables) -> DataFrame:
    return hybrid_hits(t).withColumn("rrf", F.round("rrf", 6))


@query("tool_retrieve", f"""WITH {_UNION_SQL}
SELECT query_id, doc_id, rank, substr(text, 1, 240) AS snippet FROM hits JOIN doc_lists USING (doc_id)""")
def tool_retrieve(t: Tables) -> DataFrame:
    return R.snippets(hybrid_hits(t), t.documents, "text")


_CHUNKED = r"""d0 AS (SELECT doc_id, lang, source, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM documents),
w0 AS (SELECT *, unnest(CASE WHEN length(body) <= 1800 THEN [0] ELSE range(0, length(body), 1600) END) AS pos FROM d0),
c0 AS (SELECT *, substr(body, pos + 1, 1800) AS text FROM w0),
chunked AS (SELECT doc_id * 1048576 + row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS doc_id, text, lang,
  source, length(text) AS n_chars FROM c0 WHERE regexp_matches(text, '\S'))"""


@query("knowledge_search", f"""WITH {_CHUNKED}, {_UNION_SQL.replace('FROM documents)', 'FROM chunked)')}
SELECT query_id, doc_id AS chunk_id, source, rank, round(rrf, 6) AS rrf, md5(text) AS digest
FROM hits JOIN doc_lists USING (doc_id)""")
def knowledge_search(t: Tables) -> DataFrame:
    """The whole path: chunk, analyse and embed the documents, load the table, search it."""
    table = VersionedTable(t.spark, fresh_dir(t.spark, "knowledge"))
    table.replace(R.knowledge_rows(spread(t.documents, "doc_id"), "doc_id", "source", "text", F.col("lang")))
    kb = table.read()
    near = R.knn_exact(roles.question_vectors(t), kb, R.leg_size(5), doc_id="chunk_id")
    worded = R.bm25(roles.question_words(t), kb, R.leg_size(5), doc_id="chunk_id")
    hits = R.rrf_union([near, worded], 5, doc_id="chunk_id").withColumn("rrf", F.round("rrf", 6))
    return (R.attach_documents(hits, kb.select("chunk_id", "source", "chunk"), "chunk_id")
            .select("query_id", "chunk_id", "source", "rank", "rrf", F.md5("chunk").alias("digest")))


@query("rag_context", f"""WITH {_UNION_SQL}
SELECT query_id, md5(string_agg('[Source: ' || source || ']' || chr(10) || '# Document ' || doc_id || chr(10) || text,
    chr(10) || chr(10) ORDER BY rank)) AS context_digest,
  string_agg(source, ', ' ORDER BY rank) AS citations, count(*) AS n_passages
FROM hits JOIN doc_lists USING (doc_id) GROUP BY 1""")
def rag_context(t: Tables) -> DataFrame:
    title = F.concat(F.lit("Document "), F.col("doc_id").cast("string"))
    return (R.context_blocks(hybrid_hits(t), t.documents, "source", title, "text")
            .select("query_id", F.md5("context").alias("context_digest"), "citations", "n_passages"))


@query("retrieval_eval", f"""WITH {roles.MEAN_VECTORS_SQL},
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM pairs)
  WHERE rank <= 5),
per AS (SELECT query_id, max(CASE WHEN rank = 1 AND label = query_id THEN 1 ELSE 0 END) AS top,
  max(CASE WHEN label = query_id THEN 1 ELSE 0 END) AS hit, avg(CASE WHEN label = query_id THEN 1 ELSE 0 END) AS share
  FROM hits GROUP BY 1)
SELECT count(*) AS n_questions, round(avg(top), 6) AS top1, round(avg(hit), 6) AS hit_at_k,
  round(avg(share), 6) AS precision_at_k FROM per""")
def retrieval_eval(t: Tables) -> DataFrame:
    asked = roles.mean_vectors(t)
    labels = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("label").cast("long").alias("label"))
    hits = R.attach_documents(R.knn_exact(asked, roles.vectors(t), 5), labels)
    return R.evaluate(hits, asked.select("query_id", F.col("query_id").alias("expected")), "label")


@query("index_consistency", """SELECT doc_id, 'document_without_vector' AS problem FROM documents
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT vec_id, 'vector_without_document' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT vec_id, 'null_vector' FROM embeddings WHERE embedding IS NULL""")
def index_consistency(t: Tables) -> DataFrame:
    return R.index_consistency(t.documents, roles.vectors(t), "doc_id")
