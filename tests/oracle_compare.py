"""Run registered plans against their DuckDB reference SQL and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Comparison: same column names, same row count, and the same multiset of
rows after rendering each value canonically (order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if isinstance(v, bytes):
        return v.hex()
    return str(v)


def canon_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = sorted(tuple(_canon(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], out


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diffs(df, con, sql):
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, st[c], dt.get(c)) for c in st if SPARK_TO_DUCK.get(st[c], st[c]) != dt.get(c)]


def compare(spark, con, name, plan, sql, sf_dir):
    t0 = time.time()
    df = plan(spark, sf_dir)
    sc, sr = spark_rows(df)
    t1 = time.time()
    dc, dr = duck_rows(con, sql)
    scn, srows = canon_rows(sc, sr)
    dcn, drows = canon_rows(dc, dr)
    types = type_diffs(df, con, sql)
    ok = scn == dcn and srows == drows and not types
    detail = ""
    if scn != dcn:
        detail = f"columns differ: spark={scn} duck={dcn}"
    elif len(srows) != len(drows):
        detail = f"rows spark={len(srows)} duck={len(drows)}"
    elif srows != drows:
        ss, ds = set(srows), set(drows)
        detail = f"spark-only e.g. {list(ss - ds)[:2]} duck-only e.g. {list(ds - ss)[:2]}"
    elif types:
        detail = f"types differ: {types}"
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tapflow.session import build_session
    from tapflow.plans.registry import all_oracle_sql, all_queries
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = all_queries(), all_oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:28s} rows-only  rows={n}")
            continue
        try:
            ok, n, secs, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            ok, n, secs, detail = False, -1, 0.0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:<7d} {secs:6.2f}s {detail}")
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
