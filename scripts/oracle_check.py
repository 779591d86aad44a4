"""Run catalog queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and the order-insensitive multiset of
rows (floats compared after rounding to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tradelens.plans.catalog import QUERIES  # noqa: E402
from tradelens.plans.oracle import ORACLE  # noqa: E402
from tradelens.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return str(v)


def rows_of(records):
    return sorted(tuple(norm(x) for x in r) for r in records)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    spark = build_session("local[8]")
    ok = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            scols = sdf.columns
            srows = sdf.collect()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS  {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(ORACLE[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:300]}")
            continue
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dtypes = {d[0]: str(d[1]) for d in res.description}
        tmap = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
                "timestamp_ntz": "TIMESTAMP"}
        bad = {k: (v, dtypes.get(k)) for k, v in stypes.items() if tmap.get(v, v) != dtypes.get(k)}
        if bad:
            print(f"TYPE  {name}: {bad}")
        if sorted(scols) != sorted(dcols):
            print(f"FAIL  {name}: columns spark={scols} duck={dcols}")
            continue
        order = sorted(range(len(scols)), key=lambda i: scols[i])
        dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
        a = rows_of([[r[i] for i in order] for r in srows])
        b = rows_of([[r[i] for i in dorder] for r in drows])
        if a == b:
            ok += 1
            print(f"OK    {name}: {len(a)} rows {ts:.1f}s")
        else:
            sa, sb = set(a), set(b)
            print(f"FAIL  {name}: rows spark={len(a)} duck={len(b)}; only-spark={sorted(sa - sb)[:3]} "
                  f"only-duck={sorted(sb - sa)[:3]} cols={[scols[i] for i in order]}")
    print(f"{ok}/{len(names)} match")


if __name__ == "__main__":
    main()
