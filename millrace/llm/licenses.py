"""Licence scan in DataFrame expressions only: TF-IDF cosine to templates, then inheritance by path.

Every line of a file, and the file as a whole, is a sparse vector over its terms; it carries a
licence when its cosine to a template reaches the threshold and it has the words that tell the licence
from its relatives. Where none does, or only rights are reserved, windows of a template's length count,
across line breaks and inside lines. SPDX lines count before both, with their whole expression. A file
without a licence takes that of the nearest directory above it that has a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import staged

#: Licence identifiers and the statements they are known by.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
]
#: Gives way to a licence named beside it, as in the head of many licence files.
RESERVED = "proprietary"
#: Words that tell a licence from its relatives, (needed, foreign). The numbers of a template are needed, too.
TELLS = {
    "CC-BY-4.0": ([], ["nc", "nd", "noderivatives", "noncommercial", "sa", "sharealike"]),
    "CC-BY-NC-4.0": (["nc"], ["nd", "noderivatives", "sa", "sharealike"]),
    "GPL-3.0": ([], ["affero", "lesser", "library"]),
    "proprietary": (["all"], []),
}
#: Titles and passages of headers and licence files. Windows must have the very words of a short one;
#: one of ``LONG`` words or more is compared by cosine, and stands beside its relatives, of which the closest counts.
PASSAGES = [
    ("AGPL-3.0", "the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("GPL-3.0", "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction"),
    ("MIT-0", "MIT No Attribution"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
LONG = 12
#: Licences that share their passages with a relative, which is known by what follows them.
RELATED = ["distribution", "advertising", "furnished"]
RELATIVES = [
    ("BSD-3-Clause", "BSD-2-Clause", r"(?i)provided\W+with\W+the\W+distribution\W+this\W+software\W+is\W+provided"),
    ("BSD-3-Clause", "BSD-4-Clause", r"(?i)all\W+advertising\W+materials\W+mentioning\W+features"),
    ("MIT", "MIT-0", r"(?i)furnished\W+to\W+do\W+so\W+the\W+software\W+is\W+provided"),
]
#: An SPDX line's expression, and what the standard writes for "not stated".
SPDX = (r"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\+?\)*"
        r"(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\+?\)*)*)")
UNSTATED = ["NONE", "NOASSERTION"]
#: A sentence's rest from a negation on that denies terms; it states no licence.
DENIED = r"(?i)\b(?:not|never|neither|nor|cannot|isn't|aren't)[ \t\r\n]+(?:[a-z]+[ \t\r\n]+){0,3}?(?:under|covered[ \t\r\n]+by|subject[ \t\r\n]+to|governed[ \t\r\n]+by)\b[^.!?;]*"
DENIES = ["under", "covered", "subject", "governed"]
#: Words so common in any text that others are looked for first.
FUNCTION_WORDS = {"a", "all", "and", "are", "by", "following", "for", "in", "is", "of", "or", "that", "the", "this", "to", "under", "with", "without"}
#: Least cosine of a match.
COSINE = 0.8


def terms(text: str) -> list[str]:
    return [t for t in re.sub("[^A-Za-z0-9]+", " ", text).lower().split(" ") if t]


def idf(templates: list[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies over the templates, and that of a term none of them has."""
    held = Counter(t for _, text in templates for t in set(terms(text)))
    return {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in held.items()}, math.log(1 + len(templates)) + 1


def telling_terms(templates: list[tuple[str, str]], cosine: float = COSINE) -> list[str]:
    """Terms of which every match holds at least one: a template's other terms alone cannot reach ``cosine``."""
    weight, _ = idf(templates)
    picked: set[str] = set()
    for _, text in templates:
        square = {t: (n * weight[t]) ** 2 for t, n in Counter(terms(text)).items()}
        total, left = sum(square.values()), sum(v for t, v in square.items() if t not in picked)
        for term in sorted(square.keys() - picked, key=lambda t: (t in FUNCTION_WORDS, -len(t), t)):  # any choice is right, rare words are quick
            if left < cosine ** 2 * total * (1 - 1e-9):
                break
            picked.add(term)
            left -= square[term]
    return sorted(picked)


def holds(text: str, words: list[str]):
    """Whether ``words`` (lower case) stand in the text, inside others, too: what is asked before a pattern or the words of a text."""
    return F.exists(F.array(F.lower(text)), lambda low: reduce(or_, [low.contains(w) for w in words], F.lit(False)))


def told_apart(templates: list[tuple[str, str]]) -> dict[str, tuple[list[str], list[str]]]:
    """Licence name to the terms that a passage needs and those that it must not have."""
    found = {}
    for name, text in templates:
        needed, foreign = TELLS.get(name, ([], []))
        found[name] = (sorted({*needed, *(t for t in terms(text) if t.isdigit())} & set(terms(text))), foreign)
    return found


def own_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """path, own_license, own_score of the files that state a licence: the best match of any line or of the whole text.

    Passages without a telling term are out at once; the others are few, and only their terms are
    exploded. A match has the terms its licence needs and none that is foreign to it (``told_apart``). Ties go
    to the licence that sorts first. NULL and empty texts state nothing.
    """
    spark = files.sparkSession
    weight, unknown = idf(templates)
    rows, told = [], told_apart(templates)
    for name, text in templates:
        needed, foreign = told[name]
        vector = {t: n * weight[t] for t, n in Counter(terms(text)).items()}
        size = math.sqrt(sum(v * v for v in vector.values()))
        rows += [(name, t, v / size, int(t in needed)) for t, v in vector.items()] + [(name, t, 0.0, -len(vector) - 1) for t in foreign]
    table = spark.createDataFrame(rows, "license string, term string, share double, told int")  # as large as the templates
    needs = spark.createDataFrame([(name, len(needed)) for name, (needed, _) in told.items()], "license string, needs int")
    idfs = spark.createDataFrame(sorted(weight.items()), "term string, idf double")
    text = F.coalesce("text", F.lit(""))
    words = F.split(F.lower(F.regexp_replace("passage", "[^A-Za-z0-9]+", " ")), " ")
    passages = (files.select("path", F.posexplode(F.concat(F.array(text), F.split(text, "\n"))).alias("at", "passage"))
                .select("path", "at", words.alias("words"))
                .filter(F.arrays_overlap("words", F.array(*[F.lit(t) for t in telling_terms(templates, cosine)]))))
    counted = staged(passages.select("path", "at", F.explode("words").alias("term")).filter("term <> ''")
                     .groupBy("path", "at", "term").agg(F.count(F.lit(1)).alias("tf")), "licence-terms")
    counts = (counted.join(F.broadcast(idfs), "term", "left").withColumn("value", F.col("tf") * F.coalesce("idf", F.lit(unknown))))
    sizes = counts.groupBy("path", "at").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("size"))
    dots = (counts.join(F.broadcast(table), "term")
            .groupBy("path", "at", "license").agg(F.sum(F.col("value") * F.col("share")).alias("dot"), F.sum("told").alias("told"))
            .join(F.broadcast(needs), "license").filter("told = needs"))
    scored = (dots.join(sizes, ["path", "at"]).withColumn("score", F.round(F.col("dot") / F.col("size"), 6))
              .filter(F.col("score") >= cosine))
    best = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license")))
    return scored.groupBy("path").agg(best.alias("best")).select(
        "path", F.col("best.license").alias("own_license"), F.col("best.score").alias("own_score"))


def window_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, passages: list[tuple[str, str]] = PASSAGES,
                    cosine: float = COSINE) -> DataFrame:
    """path, own_license, own_score of the files with a window of words that states a licence.

    A window has the length of a template and stands where one of its telling words falls in place;
    it must hold the words its licence needs, none that is foreign to it, and reach ``cosine``, or, for short ``passages``,
    have the very words. A long passage is looked for at its three longest words. Of
    equal scores the longer template counts, then the licence that sorts first.
    """
    weight, unknown = idf(templates + passages)
    telling, entries = set(telling_terms(templates, cosine)), []
    for at, (name, text) in enumerate(templates + passages):
        held = terms(text)
        exact = at >= len(templates) and len(held) < LONG
        longest = sorted(set(held), key=lambda t: (t in FUNCTION_WORDS, -len(t), t))
        anchors = telling & set(held) if at < len(templates) else set(longest[:1 if exact else 3])
        needed, foreign = told_apart([(name, text)])[name]
        values = {t: n * weight[t] for t, n in Counter(held).items()}
        size = math.sqrt(sum(v * v for v in values.values()))
        entries += [(anchor, name, offset, held, needed, foreign, {t: v / size for t, v in values.items()}, exact)
                    for anchor in sorted(anchors) for offset, term in enumerate(held) if term == anchor]
    spark = files.sparkSession
    table = spark.createDataFrame(entries, "anchor string, license string, offset int, held array<string>, needed array<string>, "
                                  "foreign array<string>, shares map<string,double>, exact boolean")  # as large as the templates
    anchors = sorted({e[0] for e in entries})
    words = F.filter(F.split(F.lower(F.regexp_replace("text", "[^A-Za-z0-9]+", " ")), " "), lambda w: w != "")
    # Short anchors stand inside many words, so they are asked for as words.
    short = "|".join("".join(f"[{c.upper()}{c}]" for c in a) for a in anchors if len(a) <= 3)
    anchored = holds("text", [a for a in anchors if len(a) > 3])
    if short:
        anchored = anchored | F.col("text").rlike(f"(?<![A-Za-z0-9])(?:{short})(?![A-Za-z0-9])")
    texts = files.filter(anchored).select("path", words.alias("words"))
    before, span = max(e[2] for e in entries), max(len(e[3]) for e in entries)
    placed = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("anchor"))), lambda x: x["anchor"].isin(anchors))
    # Every anchor takes the words around it along, not the whole text.
    around = F.transform(placed, lambda x: F.struct(
        F.least(x["at"], F.lit(before)).alias("at"), x["anchor"].alias("anchor"),
        F.slice("words", F.greatest(F.lit(1), x["at"] - before + 1), before + span).alias("near")))
    found = (texts.select("path", F.explode(around).alias("x")).select("path", "x.at", "x.anchor", "x.near")
             .join(F.broadcast(table), "anchor").filter("at >= offset")
             .withColumn("window", F.slice("near", F.greatest(F.lit(1), F.col("at") - F.col("offset") + 1), F.size("held"))).drop("near")
             .filter(F.size("window") == F.size("held"))
             .filter(F.when(F.col("exact"), F.col("window") == F.col("held"))
                     .otherwise((F.size(F.array_except("needed", "window")) == 0) & ~F.arrays_overlap("foreign", "window"))))
    idfs = F.create_map(*[F.lit(x) for pair in sorted(weight.items()) for x in pair])
    counts = F.transform(F.array_distinct("window"), lambda t: F.struct(
        t.alias("term"), (F.size(F.filter("window", lambda w: w == t)) * F.coalesce(idfs[t], F.lit(unknown))).alias("value")))
    dot = F.aggregate("counts", F.lit(0.0), lambda total, c: total + c["value"] * F.coalesce(F.col("shares")[c["term"]], F.lit(0.0)))
    size = F.sqrt(F.aggregate("counts", F.lit(0.0), lambda total, c: total + c["value"] * c["value"]))
    scored = found.withColumn("counts", counts).withColumn("score", F.round(dot / size, 6)).filter(F.col("score") >= cosine)
    best = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), -F.size("held"), F.col("license")))
    return scored.groupBy("path").agg(best.alias("best")).select(
        "path", F.col("best.license").alias("own_license"), F.col("best.score").alias("own_score"))


def spdx_licenses(files: DataFrame) -> DataFrame:
    """path, spdx of the files with SPDX lines: their expressions, joined by ``AND`` if several differ.

    Identifiers outside the templates are taken as written. Of several rows for one path the expression that sorts first counts.
    """
    stated = F.array_except(F.regexp_extract_all("text", F.lit(SPDX), 1), F.array(*[F.lit(x) for x in UNSTATED]))
    many = F.transform(stated, lambda x: F.when((F.size(stated) > 1) & x.contains(" OR "), F.concat(F.lit("("), x, F.lit(")"))).otherwise(x))
    return (files.filter(F.col("text").contains("SPDX-License-Identifier:")).select("path", F.array_join(F.array_sort(many), " AND ").alias("spdx"))
            .filter("spdx <> ''").groupBy("path").agg(F.min("spdx").alias("spdx")))


def relative_licenses(files: DataFrame) -> DataFrame:
    """path, relatives (licence to relative) of the files with the words of a relative."""
    held = F.array_compact(F.array(*[F.when(F.col("text").rlike(words), F.lit(k)) for k, (_, _, words) in enumerate(RELATIVES)]))
    names = F.array(*[F.struct(F.lit(a).alias("license"), F.lit(b).alias("relative")) for a, b, _ in RELATIVES])
    rows = files.filter(holds("text", RELATED)).select("path", F.explode(held).alias("k")).groupBy("path").agg(F.collect_set("k").alias("k"))  # as many as RELATIVES
    return rows.select("path", F.transform(F.array_sort("k"), lambda k: names[k]).alias("relatives"))


def directory_of(path: str):
    """What stands before the last ``/``; empty for the top."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``files`` (path, text, licence_file): path, own_license, own_score, license, evidence, from_directory.

    ``licence_file`` marks files that speak for their directory when they state a licence; of
    several, the one with the smallest path does. Evidence is ``own``, ``inherited`` or ``none``. A
    file's own statement wins over any directory; else the deepest directory above the file that
    has a licence, the top (empty name) included. An SPDX line is the file's own statement, with score 1, before
    any other wording; a sentence that denies a licence (``DENIED``) states none. Directories are resolved once each, so a folder
    that holds a third of all files is one row until the last join. A NULL path has no directory
    and inherits nothing; its own statement counts if its text has one. Repeated paths are judged together, by all their texts.
    Empty tables give empty results.
    """
    keyed = files.withColumn("_path", F.coalesce("path", F.lit("\x00")))
    raw = keyed.select(F.col("_path").alias("path"), "text")
    texts = raw.select("path", F.when(holds("text", DENIES), F.regexp_replace("text", DENIED, " ")).otherwise(F.col("text")).alias("text"))
    stated = staged(own_licenses(texts, templates, cosine), "own-licences")
    windows = staged(window_licenses(texts, templates, PASSAGES, cosine), "window-licences")
    wide = windows.select("path", F.col("own_license").alias("_license"), F.col("own_score").alias("_score"))
    other = F.col("own_license").isNull() | ((F.col("own_license") == RESERVED) & (F.col("_license") != RESERVED) & (F.col("_score") >= F.col("own_score")))
    own = stated.join(wide, "path", "full").select("path", F.when(other, F.col("_license")).otherwise(F.col("own_license")).alias("own_license"),
                                                   F.when(other, F.col("_score")).otherwise(F.col("own_score")).alias("own_score"))
    named = F.filter("relatives", lambda r: r["license"] == F.col("own_license"))
    own = (own.join(relative_licenses(raw), "path", "left").join(spdx_licenses(raw), "path", "full")
           .select("path", F.coalesce("spdx", F.try_element_at(named, F.lit(1))["relative"], "own_license").alias("own_license"),
                   F.when(F.col("spdx").isNotNull(), 1.0).otherwise(F.col("own_score")).alias("own_score")))
    rows = keyed.select("path", "_path", F.coalesce("licence_file", F.lit(False)).alias("licence_file"),
                        F.when(F.col("path").isNotNull(), directory_of("path")).alias("dir"))
    rows = rows.join(own.withColumnRenamed("path", "_own"), F.col("_path") == F.col("_own"), "left")
    speaking = (rows.filter("licence_file AND own_license IS NOT NULL AND dir IS NOT NULL")
                .groupBy(F.col("dir").alias("above")).agg(F.min_by("own_license", "path").alias("dir_license")))
    parts = F.split("dir", "/")
    # "a/b" has the directories "a/b", "a" and "" above its files.
    ups = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    nearest = (rows.select("dir").filter("dir IS NOT NULL").distinct().select("dir", F.posexplode(ups).alias("depth", "above"))
               .join(speaking, "above").groupBy(F.col("dir").alias("_dir"))
               .agg(F.max_by("dir_license", "depth").alias("inherited"), F.max_by("above", "depth").alias("source_dir")))
    has_own = F.col("own_license").isNotNull()
    return (rows.join(nearest, F.col("dir") == F.col("_dir"), "left")
            .select("path", "own_license", "own_score", F.coalesce("own_license", "inherited").alias("license"),
                    F.when(has_own, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("evidence"),
                    F.when(~has_own, F.col("source_dir")).alias("from_directory")))
