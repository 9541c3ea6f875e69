"""Run a registered query and its SQL, and compare them as sorted rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return v + 0.0
    return v


def _key(row):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=_key)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_names, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_names, want = table([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {sorted(set(got_names) ^ set(want_names))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(got_names, a, b) if x != y]
            return f"{cells[:4]} in {a[:4]}"
    return None
