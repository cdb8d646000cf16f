"""Order-insensitive comparison of a Spark result with a SQL result over the same parquet files."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def run_sql(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _cell(v):
    if v is None:
        return "~null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (str(int(v)) if v.is_integer() else repr(round(v, 6)))
    return str(v)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, sql: str, sf_dir: str, show: int = 3) -> str:
    """Empty when equal, else what differs."""
    rows = [tuple(r) for r in spark_df.collect()]
    names, expected = run_sql(sql, sf_dir)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    a, b = normal(spark_df.columns, rows), normal(names, expected)
    if a == b:
        return ""
    only_a = [r for r in a if r not in set(b)][:show]
    only_b = [r for r in b if r not in set(a)][:show]
    return f"{len(a)} rows vs {len(b)}; columns {sorted(names)}; only spark {only_a}; only sql {only_b}"
