"""Spark result vs DuckDB oracle: row count, columns, order-free values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return repr(v)


def digest(cols, rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    return {"cols": ok_cols, "rows": (sn, dn), "hash": sh == dh,
            "s_cols": sorted(s_cols), "d_cols": sorted(d_cols), "s_rows": s_rows, "d_rows": d_rows}
