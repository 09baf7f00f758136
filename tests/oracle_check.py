"""Run registered Spark queries next to their DuckDB oracle text and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (columns sorted by
name), exactly as values, like the driver's order-insensitive hash.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


SPARK_TO_DUCK = {
    "IntegerType": "INTEGER",
    "LongType": "BIGINT",
    "DoubleType": "DOUBLE",
    "StringType": "VARCHAR",
    "DateType": "DATE",
    "BooleanType": "BOOLEAN",
    "TimestampNTZType": "TIMESTAMP",
}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    type_diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
    if type_diff:
        print(f"   types differ in {name}: {type_diff}")
    a, acols = rows_of(sdf.columns, srows)
    b, bcols = rows_of(dcols, drows)
    ok_cols = acols == bcols
    ok_n = len(a) == len(b)
    ca, cb = Counter(a), Counter(b)
    ok_vals = ca == cb
    status = "OK" if (ok_cols and ok_n and ok_vals) else "MISMATCH"
    print(f"{status:8s} {name:32s} spark={len(a):7d} duck={len(b):7d} {t1 - t0:6.2f}s", flush=True)
    if not ok_cols:
        print("   cols spark:", acols, "\n   cols duck: ", bcols)
    if ok_cols and not ok_vals:
        da = list((ca - cb).elements())[:3]
        db = list((cb - ca).elements())[:3]
        print("   only spark:", da, "\n   only duck: ", db)
    return status == "OK"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from newsrisk.session import get_spark

    spark = get_spark()
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = []
    for name in names or list(qs):
        try:
            if name not in os_:
                t0 = time.time()
                n = qs[name](spark, sf_dir).count()
                print(f"ROWS     {name:32s} spark={n:7d} (no oracle) {time.time() - t0:6.2f}s", flush=True)
                continue
            if not compare(spark, con, name, qs[name], os_[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and continue
            print(f"ERROR    {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
