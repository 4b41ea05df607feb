"""Order-insensitive comparison of a Spark result with the SQL twin's."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from millrace.sources.tables import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value) if not isinstance(value, bool) else f"bool {value}"


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(str([plain(r[i]) for i in order]) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = table([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{a[:300]} != {b[:300]}"
    return None
