"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_check.py [--sf DIR] [key ...]
Compares row count, column names, a coarse type class per column and an
order-insensitive hash of the values (floats printed with 9 significant digits).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import json
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if np.isnan(v):
            return "∅"
        return f"{v:.9g}"
    if isinstance(v, (np.floating,)):
        return _canon(float(v))
    if isinstance(v, (np.integer,)):
        return str(int(v))
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, decimal.Decimal):
        return _canon(float(v))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    if v is pd.NaT:
        return "∅"
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    return str(v)


def _kind(dtype) -> str:
    s = str(dtype)
    if "int" in s.lower():
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    if "datetime" in s:
        return "ts"
    return "obj"


def digest(df: pd.DataFrame) -> tuple[list[str], list[str], int, str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_canon(r[c]) for c in cols) for _, r in df[cols].iterrows())
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return cols, [_kind(df[c].dtype) for c in cols], len(df), h


def compare(spark, key: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    out = {"key": key, "spark_rows": len(sp), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    dk = con.execute(sql).df()
    out["oracle_rows"] = len(dk)
    sc, sk, sn, sh = digest(sp)
    dc, dkk, dn, dh = digest(dk)
    out["names"] = sc == dc
    out["kinds"] = sk == dkk
    out["rows"] = sn == dn
    out["hash"] = sh == dh
    out["status"] = "ok" if (sc == dc and sn == dn and sh == dh) else "MISMATCH"
    if sc != dc:
        out["spark_cols"], out["oracle_cols"] = sc, dc
    elif sk != dkk:
        out["kinds_detail"] = [(c, a, b) for c, a, b in zip(sc, sk, dkk) if a != b]
    if out["status"] != "ok" and sc == dc:
        a = sp[sc].map(_canon) if hasattr(sp, "map") else sp[sc].applymap(_canon)
        b = dk[dc].map(_canon) if hasattr(dk, "map") else dk[dc].applymap(_canon)
        ra = set("|".join(r) for r in a.itertuples(index=False))
        rb = set("|".join(r) for r in b.itertuples(index=False))
        out["only_spark"] = sorted(ra - rb)[:3]
        out["only_oracle"] = sorted(rb - ra)[:3]
    return out


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from __spark_entry__ import oracle_sql, queries

    from ledgerlink.session import build_session, checkpoint_dir
    spark = build_session("local[8]", 8)
    checkpoint_dir(spark, allow_local_default=True)
    qs, sq = queries(), oracle_sql()
    con = duck(a.sf)
    keys = a.keys or sorted(qs)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, qs[k], sq.get(k), a.sf, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(json.dumps(r, default=str), flush=True)
    print(json.dumps({"checked": len(keys), "bad": bad}))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
