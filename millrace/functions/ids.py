"""Identifiers that a retried task computes again unchanged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_uuid(*parts: str | Column) -> Column:
    """UUID-shaped text from the MD5 of the parts, each with its length; the same key gives the same id.

    The lengths keep ("a|b", "c") and ("a", "b|c") apart, and a missing part is not an empty one.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    digest = F.md5(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t, F.lit("|")), F.lit("|")) for t in texts]).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
