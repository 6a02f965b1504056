"""Run registered queries and their DuckDB oracles side by side.

Usage: python tools/compare.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import decimal
import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

VIEWS = ("region nation customer supplier part orders lineitem events documents "
         "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from shelfwise.plans.catalog import all_oracles, all_queries
    from shelfwise.session import build_session
    spark = build_session()
    con = duckdb.connect()
    for v in VIEWS:
        p = f"{sf_dir}/{v}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    qs, ors = all_queries(), all_oracles()
    report = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            report[name] = {"error": repr(e)[:500]}
            print(name, "SPARK ERROR", repr(e)[:2000])
            continue
        dt = time.time() - t0
        entry = {"rows": len(rows), "sec": round(dt, 2)}
        if name in ors:
            try:
                res = con.execute(ors[name])
                ocols = [d[0] for d in res.description]
                orows = res.fetchall()
                entry.update(oracle_rows=len(orows),
                             cols_match=sorted(cols) == sorted(ocols),
                             hash_match=digest(cols, rows) == digest(ocols, orows))
                if not entry["cols_match"]:
                    entry["cols"] = [cols, ocols]
            except Exception as e:  # noqa: BLE001
                entry["oracle_error"] = repr(e)[:500]
        report[name] = entry
        print(name, json.dumps(entry), flush=True)
    spark.stop()
    bad = [k for k, v in report.items()
           if "error" in v or "oracle_error" in v or v.get("hash_match") is False
           or v.get("cols_match") is False]
    print("MISMATCH:", bad)


if __name__ == "__main__":
    main(sys.argv)
