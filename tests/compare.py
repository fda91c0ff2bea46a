"""Compare Spark results with DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    return value


def _sorted(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: tuple((c is None, str(type(c)), c if c is not None else 0) for c in r))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _sorted(names, result.fetchall())
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        extra = set(map(str, got)) - set(map(str, want))
        lost = set(map(str, want)) - set(map(str, got))
        return f"{len(got)} rows against {len(want)}; extra {list(extra)[:2]} lost {list(lost)[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None
