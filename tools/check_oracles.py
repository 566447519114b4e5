"""Run each registered query in Spark and its SQL in DuckDB; compare results.

Usage: python tools/check_oracles.py [sf_dir] [name ...]
Prints one line per query: rows, column match, value match, seconds.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from fieldwise.plans.registry_all import all_queries  # noqa: E402
from fieldwise.session import local_session  # noqa: E402
from fieldwise.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, reg in all_queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = reg.build(spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if reg.sql is None:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(reg.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB-ERROR {str(e)[:300]}")
            bad += 1
            continue
        colok = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        valok = a == b
        flag = "OK " if (colok and valok) else "BAD"
        if flag == "BAD":
            bad += 1
        print(f"{name:28s} {flag} rows spark={len(srows)} duck={len(drows)} cols={'ok' if colok else (sorted(scols), sorted(dcols))} values={'ok' if valok else 'DIFF'} {ts:.1f}s")
        if not valok and colok:
            sa, sb = set(a), set(b)
            print("   spark-only:", sorted(sa - sb)[:3])
            print("   duck-only: ", sorted(sb - sa)[:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()
