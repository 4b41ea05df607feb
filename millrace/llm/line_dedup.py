"""Lines that many sites share, found by HyperLogLog sketches of the sites of each line hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import staged
from millrace.llm.words import single_spaced, text_or_empty

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 5
#: log2 of the registers of a sketch; the standard error is 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12
#: Estimates this close to the threshold (6 standard errors, and at least one site) are counted exactly.
MARGIN = 0.1


def line_key(line: Column) -> Column:
    """128-bit hash of the trimmed, single-spaced line; NULL for blank lines."""
    plain = F.trim(single_spaced(line))
    return F.when(plain != "", F.struct(F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit("line"), plain).alias("h2")))


def site_lines(docs: DataFrame) -> DataFrame:
    """doc_id, site, h1, h2 for each line that is not blank."""
    return (docs.select("doc_id", F.coalesce("source", F.lit("")).alias("site"),
                        F.explode(F.split(text_or_empty(), "\n")).alias("line"))
            .select("doc_id", "site", line_key(F.col("line")).alias("key")).filter("key IS NOT NULL")
            .select("doc_id", "site", "key.h1", "key.h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """Lines on at least ``min_sites`` distinct sites: h1, h2, first_doc (smallest doc_id).

    Sketches are built before the shuffle and merged after it, so a line of any frequency is one
    row per task. Lines near the threshold get exact distinct counts.
    """
    gap = max(1.0, min_sites * margin)
    spread = (lines.groupBy("h1", "h2")
              .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"), F.min("doc_id").alias("first_doc")))
    wide = staged(spread.filter(F.col("sites") >= min_sites - gap), "wide-lines")
    near = wide.filter(F.col("sites") <= min_sites + gap).select("h1", "h2")
    exact = (lines.select("h1", "h2", "site").join(near, ["h1", "h2"], "left_semi").distinct()
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("exact_sites")))
    return (wide.join(exact, ["h1", "h2"], "left")
            .filter(F.coalesce("exact_sites", "sites") >= min_sites).select("h1", "h2", "first_doc"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with shared lines removed from ``text``, plus n_lines and n_removed.

    A line that stands on ``min_sites`` or more distinct sites (NULL is a site) stays in the
    document with the smallest doc_id that holds it, so no wording is lost, and goes from all
    others. Lines are compared trimmed and single-spaced; blank lines always stay. NULL and empty
    texts have no lines and stay as they are; a document may lose all its lines and then has an
    empty text. Rows that share a doc_id are treated alike. Columns n_lines and n_removed of
    ``docs`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = staged(site_lines(docs), "lines")
    # Written first, so that the join below stands alone and a busy line can be split over tasks.
    shared = staged(boilerplate(lines, min_sites), "boilerplate")
    marked = (lines.join(shared, ["h1", "h2"])
              .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
              .groupBy(F.col("doc_id").alias("marked_doc")).agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))
    # The row travels in a struct, so no column of it can clash with those added here.
    rows = docs.select(F.struct(*names).alias("row"), "doc_id", F.split(text_or_empty(), "\n").alias("parts"), (text_or_empty() == "").alias("empty"))
    kept = F.filter("parts", lambda line: ~F.coalesce(F.array_contains("gone", line_key(line)), F.lit(False)))
    joined = (rows.join(marked, F.col("doc_id").eqNullSafe(F.col("marked_doc")), "left")
              .withColumn("kept", F.when(F.col("gone").isNull(), F.col("parts")).otherwise(kept)))
    return joined.select(
        *[F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join("kept", "\n")).alias("text")
          if c == "text" else F.col("row")[c].alias(c) for c in names],
        F.when(F.col("empty"), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        (F.size("parts") - F.size("kept")).cast("long").alias("n_removed"))
