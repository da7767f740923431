"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "is_integer") and not isinstance(v, int):  # Decimal
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from fernwood.session import local_session
    from fernwood.plans.registry import queries, oracle_sql
    spark = local_session()
    qs, sq = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sq:
            print(f"ROWS {name}: {len(srows)} rows, {dt:.2f}s (no oracle)")
            continue
        try:
            rel = con.sql(sq[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns {sorted(scols)} vs {sorted(dcols)}")
            bad += 1
            continue
        h1, l1 = digest(scols, srows)
        h2, l2 = digest(dcols, drows)
        if len(srows) != len(drows) or h1 != h2:
            print(f"FAIL {name}: rows {len(srows)} vs {len(drows)}")
            only_s = sorted(set(l1) - set(l2))[:5]
            only_d = sorted(set(l2) - set(l1))[:5]
            print("   spark only:", only_s)
            print("   duck  only:", only_d)
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows, {dt:.2f}s")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
