"""The registered queries: each applies one operator to its whole table and derives the result columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, collocations, decontaminate, exact_dedup, katz, licenses, line_dedup, pu_quality, simhash, substring_dedup, toxicity, url_filter, vector_codes
from millrace.llm.registry import llm_query
from millrace.sources.tables import Tables

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


@llm_query("op1_exact_dedup", rf"""
WITH n AS (SELECT doc_id, {_NORMAL} AS normal FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(normal) AS text_sha256
FROM n WINDOW w AS (PARTITION BY normal)""")
def op1_exact_dedup(t: Tables) -> DataFrame:
    return exact_dedup.exact_dedup(t.documents)


def tokenizer() -> byte_bpe.Vocabulary:
    """The multilingual byte-level vocabulary of the public tokenizers package."""
    import public_tokenizers
    return byte_bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, spaced=True)


def token_digests(docs: DataFrame, vocabulary: byte_bpe.Vocabulary) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = byte_bpe.encode(docs, vocabulary, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@llm_query("op2_byte_bpe")
def op2_byte_bpe(t: Tables) -> DataFrame:
    return token_digests(t.documents, tokenizer())


@llm_query("op3_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS key
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) AS first_doc FROM s),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g WHERE first_doc < doc_id),
k AS (SELECT d.doc_id, count(x.p) AS n_removed, string_agg(word, ' ' ORDER BY q.p) FILTER (x.p IS NULL) AS kept
      FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d) q
      JOIN d USING (doc_id) LEFT JOIN x ON x.doc_id = q.doc_id AND x.p = q.p GROUP BY d.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op3_substring_dedup(t: Tables) -> DataFrame:
    found = substring_dedup.remove_repeats(t.documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@llm_query("op4_simhash")
def op4_simhash(t: Tables) -> DataFrame:
    found = simhash.simhash_components(t.documents)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@llm_query("op5_katz")
def op5_katz(t: Tables) -> DataFrame:
    held_out = F.coalesce(pu_quality.fold(F.col("doc_id"), 7) == 2, F.lit(False))
    found = katz.katz_scores(t.documents.select("doc_id", "text", (~held_out).alias("learn")))
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _license_sql() -> str:
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES)
    told = licenses.told_apart(licenses.TEMPLATES)
    tells = ", ".join(f"('{n}', '{t}', {kind})" for n, sides in told.items() for kind, side in enumerate(sides) for t in side)
    denied, spdx = licenses.DENIED.replace("'", "''"), licenses.SPDX.replace("'", "''")
    words = "string_split(lower(regexp_replace({0}, '[^A-Za-z0-9]+', ' ', 'g')), ' ')"
    return rf"""
WITH t(license, text) AS (VALUES {values}),
tt AS (SELECT license, term, count(*) AS tf FROM (SELECT license, unnest({words.format("text")}) AS term FROM t) WHERE term <> '' GROUP BY ALL),
i AS (SELECT term, ln((1.0 + (SELECT count(*) FROM t)) / (1 + count(*))) + 1 AS idf FROM tt GROUP BY term),
tv AS (SELECT license, tt.term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY license)) AS share FROM tt JOIN i USING (term)),
k(license, term, kind) AS (VALUES {tells}),
f AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{denied}', ' ', 'g') AS text,
             concat_ws('/', source, CASE WHEN doc_id % 10 > 0 THEN lang END,
                       CASE WHEN doc_id % 10 > 2 THEN CAST(doc_id // 100 AS VARCHAR) END) AS dir FROM documents),
p AS (SELECT doc_id, 0 AS pos, text AS passage FROM f
      UNION ALL SELECT doc_id, unnest(range(1, len(parts) + 1)), unnest(parts) FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM f)),
c AS (SELECT doc_id, pos, term, count(*) AS tf FROM (SELECT doc_id, pos, unnest({words.format("passage")}) AS term FROM p) WHERE term <> '' GROUP BY ALL),
v AS (SELECT doc_id, pos, c.term, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM t)) + 1) AS value FROM c LEFT JOIN i USING (term)),
n AS (SELECT doc_id, pos, sqrt(sum(value * value)) AS size FROM v GROUP BY ALL),
s AS (SELECT doc_id, license, round(sum(value * share) / any_value(size), 6) AS score
      FROM v JOIN tv USING (term) JOIN n USING (doc_id, pos) GROUP BY doc_id, pos, license
      HAVING count(*) FILTER ((license, term, 0) IN (SELECT (license, term, kind) FROM k)) = (SELECT count(*) FROM k WHERE k.license = tv.license AND kind = 0)
         AND NOT EXISTS (SELECT 1 FROM c JOIN k USING (term) WHERE c.doc_id = v.doc_id AND c.pos = v.pos AND k.license = tv.license AND kind = 1)),
x AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '{spdx}', 1),
             lambda i: i NOT IN ('NONE', 'NOASSERTION')))), ' AND ') AS spdx FROM f),
b AS (SELECT doc_id, license, score FROM s WHERE score >= 0.8
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
o AS (SELECT doc_id, CASE WHEN spdx <> '' THEN spdx ELSE license END AS own_license, CASE WHEN spdx <> '' THEN 1.0::DOUBLE ELSE score END AS own_score
      FROM x LEFT JOIN b USING (doc_id) WHERE spdx <> '' OR license IS NOT NULL),
d AS (SELECT dir, own_license AS dir_license FROM f JOIN o USING (doc_id)
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY dir || '/' || doc_id) = 1),
h AS (SELECT f.doc_id, d.dir, d.dir_license FROM f JOIN d ON f.dir = d.dir OR starts_with(f.dir, d.dir || '/')
      QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(d.dir) DESC) = 1)
SELECT f.doc_id, own_license, own_score, coalesce(own_license, dir_license) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS evidence,
       CASE WHEN own_license IS NULL THEN h.dir END AS from_directory
FROM f LEFT JOIN o USING (doc_id) LEFT JOIN h USING (doc_id)"""


@llm_query("op6_licenses", _license_sql())
def op6_licenses(t: Tables) -> DataFrame:
    """Documents have no paths: they are put into a tree by source, language and hundred, at three depths."""
    ident = F.col("doc_id")
    folder = F.concat_ws("/", "source", F.when(ident % 10 > 0, F.col("lang")),
                         F.when(ident % 10 > 2, F.floor(ident / 100).cast("string")))
    files = t.documents.select(F.concat_ws("/", folder, ident).alias("path"), "text", F.lit(True).alias("licence_file"))
    found = licenses.scan_licenses(files)
    return found.select(F.regexp_extract("path", "([^/]*)$", 1).cast("long").alias("doc_id"), "own_license", "own_score",
                        "license", "evidence", "from_directory")


#: Rules of the contract, in its order: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@llm_query("op7_url_filter", r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(verdict, h, pre) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                              ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT page_id, h || pre AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || pre) DESC) AS k
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.k = 1""")
def op7_url_filter(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([(h, p, v) for v, h, p in URL_RULES], "host string, path string, verdict string")
    return url_filter.match_urls(t.pages, rules)


@llm_query("op8_pu_quality")
def op8_pu_quality(t: Tables) -> DataFrame:
    letters = pu_quality.letter_table(t.documents)
    rows = pu_quality.featured(t.documents, letters)
    found = pu_quality.scored(rows, pu_quality.fit(rows, t.labels, letters))
    return found.select("doc_id", F.coalesce(pu_quality.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= pu_quality.THRESHOLD).cast("int").alias("predicted"))


_WORDS9 = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@llm_query("op9_decontamination", rf"""
WITH d AS (SELECT doc_id, {_WORDS9.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS9.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size,
         array_to_string(w[i:i + 12], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (size, key)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op9_decontamination(t: Tables) -> DataFrame:
    found = decontaminate.find_passages(t.documents.select("doc_id", "text"), t.benchmark)
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


_LINE = r"trim(regexp_replace({0}, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"


@llm_query("op10_line_dedup", rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, site, i, parts[i] AS line, {_LINE.format("parts[i]")} AS plain
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM d)),
b AS (SELECT plain, min(doc_id) AS first_doc FROM l WHERE plain <> '' GROUP BY plain HAVING count(DISTINCT site) >= 5),
k AS (SELECT l.*, b.first_doc IS NOT NULL AND l.doc_id <> b.first_doc AS gone FROM l LEFT JOIN b USING (plain)),
g AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(parts) END AS n_lines, n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d JOIN g USING (doc_id) JOIN documents USING (doc_id)""")
def op10_line_dedup(t: Tables) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(t.documents)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@llm_query("op11_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS tail, j
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cuts.*, h.a AS l, t.a AS r, n, CAST((1000::HUGEINT * cuts.a * n) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
      FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail JOIN n ON n.lang = cuts.lang
      QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM s WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.lang = s.lang AND c.k > s.k AND 100 * c.a >= 100 * s.a AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) WHERE rank <= 2000""")
def op11_collocations(t: Tables) -> DataFrame:
    return collocations.phrases(t.documents)


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT rid, part, entry, d FROM (
  SELECT x.rid, part, b.entry, sum((x.val - b.val) * (x.val - b.val)) AS d FROM x JOIN b{i} b USING (part, pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) = 1)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT part, entry, pos, sum(val) AS s, count(*) AS c FROM a{i} JOIN x USING (rid, part) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, entry, pos, CAST(coalesce((s - ((s % c) + c) % c) // c, b.val) AS BIGINT) AS val
  FROM b{i} b LEFT JOIN m{i} USING (part, entry, pos))""")
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, len(embedding) // 4 AS wide,
    list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
x AS MATERIALIZED (SELECT rid, p // wide AS part, p % wide AS pos, q[p + 1] AS val FROM (SELECT *, unnest(range(len(q))) AS p FROM v)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, val FROM x WHERE rid <= 256),
{", ".join(steps)},
e AS (SELECT rid, CAST(sum(d) AS BIGINT) AS error, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN e USING (rid)"""


@llm_query("op12_vector_codes", _codes_sql())
def op12_vector_codes(t: Tables) -> DataFrame:
    coded, books = vector_codes.vector_codes(t.embeddings)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256"))


@llm_query("op13_toxicity")
def op13_toxicity(t: Tables) -> DataFrame:
    found = toxicity.scored(t.documents, toxicity.fit(t.documents, t.labels))
    return found.select("doc_id", F.coalesce(pu_quality.fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))
