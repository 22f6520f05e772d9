"""Compare a Spark query with its DuckDB oracle: row count, columns, values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v.to_integral() else str(v))
    if isinstance(v, float):
        return ("num", None if math.isnan(v) else repr(v))
    if isinstance(v, int):
        return ("num", repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("ts", dt.datetime(v.year, v.month, v.day).isoformat())
    return ("str", str(v))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        return False, (
            f"rows spark={len(s_rows)} duck={len(d_rows)}; cols={order}\n"
            f"  only spark: {only_s}\n  only duck: {only_d}"
        )
    return True, f"{len(s_rows)} rows (spark {t1 - t0:.1f}s, duck {t2 - t1:.1f}s)"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from tillroll.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(qs)
    bad = 0
    for name in names:
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows", flush=True)
            continue
        try:
            ok, msg = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
