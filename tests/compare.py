"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, type(v).__name__, repr(v)) for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows."""
    s_names, s_rows = spark_rows(df)
    d_names, d_rows = duck_rows(con, sql)
    if s_names != d_names:
        return f"columns {s_names} != {d_names}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} != {len(d_rows)}: {s_rows[:2]} / {d_rows[:2]}"
    ours, theirs = Counter(map(_key, s_rows)), Counter(map(_key, d_rows))
    extra, missing = sorted((ours - theirs).elements()), sorted((theirs - ours).elements())
    if not extra:
        return None

    def near(row: tuple) -> tuple:
        return max(missing, key=lambda other: sum(a == b for a, b in zip(row, other, strict=True)))

    a, b = extra[0], near(extra[0])
    cells = [(n, x[2], y[2]) for n, x, y in zip(s_names, a, b, strict=True) if x != y]
    return f"{len(extra)} of {len(s_rows)} rows differ, for example: {cells}"
