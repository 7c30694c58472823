"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names (sorted) and an
order-insensitive hash of the values.  Usable from pytest and as a CLI:

    python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return sorted(columns), len(rows), h, lines


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    return list(df.columns), rows


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, con, name, fn, sql, sf_dir, show=5):
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    a, b = digest(sc, sr), digest(dc, dr)
    ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
    detail = ""
    if not ok:
        detail = f"cols spark={a[0]} duck={b[0]} rows spark={a[1]} duck={b[1]}"
        sa, sb = set(a[3]), set(b[3])
        only_s = sorted(sa - sb)[:show]
        only_d = sorted(sb - sa)[:show]
        detail += f"\n  only spark: {only_s}\n  only duck: {only_d}"
    return ok, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from repolens.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    import os
    tz = os.environ.get("ORACLE_TZ")   # check results do not depend on the session time zone
    spark = build_session(extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        if n not in os_:
            df = qs[n](spark, sf_dir)
            print(f"ROWS-ONLY {n}: {df.count()} rows")
            continue
        try:
            ok, detail = compare(spark, con, n, qs[n], os_[n], sf_dir)
        except Exception as e:  # report and go on
            ok, detail = False, f"ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(("OK   " if ok else "FAIL ") + n + ("" if ok else "\n  " + detail), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
