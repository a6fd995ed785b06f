"""Run registered Spark queries and their DuckDB oracle SQL on the same parquet tables
and compare column names, row counts and order-insensitive values.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from strandline.plans.oracle import ORACLE_SQL
    from strandline.plans.queries import QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    dd = con.execute(ORACLE_SQL[name]).fetchdf()
    t2 = time.time()
    msg = f"{name}: spark {len(sp)} rows {t1 - t0:.1f}s, duckdb {len(dd)} rows {t2 - t1:.1f}s"
    if sorted(sp.columns) != sorted(dd.columns):
        return False, msg + f" COLUMNS {sorted(sp.columns)} vs {sorted(dd.columns)}"
    if len(sp) != len(dd):
        return False, msg + " ROWCOUNT"
    a, b = _rows(sp), _rows(dd)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, msg + f" VALUES first diffs {bad}"
    return True, msg + " OK"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strandline.plans.queries import QUERIES
    from strandline.session import build_session
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    fails = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(msg, flush=True)
    print(f"{len(names) - fails}/{len(names)} passed")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main())
