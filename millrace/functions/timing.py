"""Time arithmetic that gives the same answer in every session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: str | Column) -> Column:
    """Microseconds between 1970-01-01 and a zone-less timestamp column."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", origin, col.cast("timestamp_ntz"))


def gap_seconds(start: str | Column, end: str | Column) -> Column:
    """Elapsed seconds from ``start`` to ``end`` as a double."""
    return (micros(end) - micros(start)) / F.lit(1e6)


def stamp(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def older_than(ts: str | Column, now: str, **span: int) -> Column:
    """``ts < now - span``; ``span`` is e.g. ``days=90`` or ``hours=24``."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return col < stamp(now) - F.make_interval(**{k: F.lit(v) for k, v in span.items()})


def newer_than(ts: str | Column, now: str, **span: int) -> Column:
    """``ts > now - span`` and not after ``now``."""
    col = F.col(ts) if isinstance(ts, str) else ts
    start = stamp(now) - F.make_interval(**{k: F.lit(v) for k, v in span.items()})
    return (col > start) & (col <= stamp(now))
