"""From raw documents to token digests in five stages, each written as Parquet before the next one reads it.

Every stage works on all rows the one before it kept. Stages but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids_sha256 and decoded_sha256. Every stage gives
an empty result for an empty table and lets NULL columns pass (a NULL text counts as empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, line_dedup, pu_quality, queries, simhash
from millrace.llm.staging import staged
from millrace.session import ship_package
from millrace.sources.tables import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts; it is fitted on ``docs`` and ``labels``."""
    ship_package(spark)
    letters = pu_quality.letter_table(docs)
    model = pu_quality.fit(pu_quality.featured(docs, letters), Tables(spark, sf_dir).labels, letters)
    return pu_quality.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share; ``n_chars`` follows the text."""
    ship_package(spark)
    cleaned = line_dedup.remove_boilerplate(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each SimHash component: three-word shingles, two differing bits at most."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, or less of it than a twentieth of their words."""
    ship_package(spark)
    return decontaminate.decontaminate(docs, Tables(spark, sf_dir).benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document that is left, and the round trip's digest."""
    ship_package(spark)
    return queries.token_digests(docs, queries.tokenizer())


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", benchmarks), ("byte_bpe", tokens)]

#: SQL expresses neither the fitted classifier nor SimHash nor BPE; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents`` of ``sf_dir``."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
