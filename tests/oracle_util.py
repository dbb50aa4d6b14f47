"""Local stand-in for the driver's correctness gate: run a Spark query and
a DuckDB oracle on the same parquet tables and compare row count, column
names and order-insensitive values (floats at 6 places)."""

from __future__ import annotations

import datetime as _dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    if hasattr(v, "toArray"):
        return tuple(round(float(x), 6) for x in v.toArray())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def compare(spark_df, con, sql):
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_check AS {sql}")  # an oracle must be one plain query
    rel = con.sql("SELECT * FROM oracle_check")
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = _canon(s_cols, s_rows)
    dc, dr = _canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark-only={sorted(set(sc)-set(dc))} "
                        f"oracle-only={sorted(set(dc)-set(sc))}")
    if len(sr) != len(dr):
        problems.append(f"rows differ: spark={len(sr)} oracle={len(dr)}")
    elif sc == dc and sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(sr), len(dr)
