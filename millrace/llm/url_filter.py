"""URL rules as a sort-merge range join.

A host is turned round (``net.example.blog.``), so that a rule for a host and its subdomains is one
interval of keys and intervals of different rules either nest or are disjoint. Urls and rules meet
in key ranges; each range is swept once in key order with a stack of the rules that are open.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Above every character of a host, so it closes a prefix interval.
_LAST = "\U0010ffff"
#: Keys looked at to balance the ranges. They decide where the ranges are cut, never what matches.
CUT_SAMPLE = 20_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """``blog.example.net`` as ``net.example.blog.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _cuts(keys: DataFrame, ranges: int) -> list[str]:
    """Keys that cut the table into about equal ranges."""
    rows = keys.count()
    share = min(1.0, CUT_SAMPLE / max(rows, 1))
    seen = sorted(r[0] for r in keys.sample(share, seed=7).limit(2 * CUT_SAMPLE).collect())
    return sorted({seen[len(seen) * i // ranges] for i in range(1, ranges)}) if seen else []


def match_urls(urls: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = "allow", ranges: int | None = None) -> DataFrame:
    """Judges every url: id, host, path, rule (host + path of the winning rule, or NULL), verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains when the url's
    path starts with the rule's path; the longest host + path wins, then the longer host, then the
    smaller verdict. Urls that no rule fits get ``default``. A NULL url, or one without ``://``, has
    an empty host and path. Rules with a NULL are ignored. A busy host is cut into several ranges
    by its ids, so no host has to fit one task. Empty tables give empty results.
    """
    ranges = ranges or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sites = urls.select(F.col(id_column).alias("_id"), host_of(F.col(url_column)).alias("host"),
                        path_of(F.col(url_column)).alias("path"))
    # The host's key first; ids after it only spread the urls of one host.
    sites = sites.withColumn("_key", F.concat(reversed_host(F.col("host")), F.lit("\x00"),
                                              F.hex(F.xxhash64("_id", "path"))))
    rules = rules.select("host", "path", "verdict").dropna().withColumn("_key", reversed_host(F.col("host")))
    cuts = _cuts(sites.select("_key"), ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A url goes to the range of its key."""
        for batch in batches:
            at = [bisect.bisect_right(cuts, k) for k in batch.column("_key").to_pylist()]
            yield batch.append_column("_range", pa.array(at, pa.int32()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A rule goes to each range that its interval touches."""
        for batch in batches:
            keys = batch.column("_key").to_pylist()
            pairs = [(i, r) for i, k in enumerate(keys)
                     for r in range(bisect.bisect_right(cuts, k), bisect.bisect_right(cuts, k + _LAST) + 1)]
            yield (batch.take(pa.array([i for i, _ in pairs], pa.int64()))
                   .append_column("_range", pa.array([r for _, r in pairs], pa.int32())))

    def layout(df: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", _range int"

    left = sites.mapInArrow(place, layout(sites)).withColumn("_kind", F.lit(1)).withColumn("verdict", F.lit(None).cast("string"))
    right = rules.mapInArrow(spread, layout(rules)).withColumn("_kind", F.lit(0))
    events = (left.unionByName(right, allowMissingColumns=True)
              .repartition(len(cuts) + 1, "_range").sortWithinPartitions("_range", "_key", "_kind"))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict[str, tuple]]] = []
        here = None
        for batch in batches:
            ids, hosts, paths, fits, verdicts = [], [], [], [], []
            columns = {c: batch.column(c).to_pylist() for c in ("_range", "_key", "_kind", "_id", "host", "path", "verdict")}
            for part, key, kind, ident, host, path, verdict in zip(*columns.values()):
                if part != here:
                    here, stack = part, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}))
                    known = stack[-1][1].get(path)
                    stack[-1][1][path] = (host, verdict if known is None else min(verdict, known[1]))
                    continue
                best = None
                for _, paths_of in stack:  # from the shortest host to the longest
                    for size in {len(p) for p in paths_of}:
                        if (hit := paths_of.get(path[:size])) and size <= len(path):
                            rank = (len(hit[0]) + size, len(hit[0]))
                            if best is None or rank > best[0]:
                                best = (rank, hit[0] + path[:size], hit[1])
                ids.append(ident)
                hosts.append(host)
                paths.append(path)
                fits.append(best and best[1])
                verdicts.append(best[2] if best else default)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column("_id").type), *(pa.array(x, pa.string()) for x in (hosts, paths, fits, verdicts))],
                ["_id", "host", "path", "rule", "verdict"])

    kind = sites.schema["_id"].dataType.simpleString()
    return (events.mapInArrow(sweep, f"_id {kind}, host string, path string, rule string, verdict string")
            .withColumnRenamed("_id", id_column))
