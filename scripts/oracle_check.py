"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [name-substring ...]
"""
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quillspark.plans.registry import TABLES, load_all  # noqa: E402
from quillspark.session import get_spark  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    reg = load_all()
    spark = get_spark(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, qy in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = qy.fn(spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if qy.sql is None:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(qy.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        if ok:
            print(f"ok   {name}: {len(srows)} rows ({ts:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: cols {scols} vs {dcols}; rows {len(srows)} vs {len(drows)}")
            a, b = set(ls), set(ld)
            for x in list(a - b)[:2]:
                print("   spark only:", x[:700])
            for x in list(b - a)[:2]:
                print("   duck  only:", x[:700])
    print("bad", bad)


if __name__ == "__main__":
    main()
