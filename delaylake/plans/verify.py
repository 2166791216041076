"""Compare a registered query with its DuckDB oracle (development check).

Row count, column names, and an order-insensitive digest of the values with
columns sorted by name (doubles optionally rounded).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return {k: _norm(x, digits) for k, x in sorted(v.items())}
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    if isinstance(v, (list, tuple)):
        return [_norm(x, digits) for x in v]
    return v


def digest(cols: list[str], rows: list[tuple], digits: int | None = None) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i], digits) for i in order], default=str) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if out["cols_match"]:
        hs, ls = digest(s_cols, s_rows)
        hd, ld = digest(d_cols, d_rows)
        out["exact"] = hs == hd
        out["diff"] = (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])
    else:
        out["exact"] = False
        out["diff"] = (sorted(s_cols), sorted(d_cols))
    return out
