"""Run registered Spark queries next to their DuckDB SQL and compare.

Row count, sorted column names and an order-insensitive hash of the values.
Usable from pytest and as a script:
    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if hasattr(v, "item"):
        return _cell(v.item())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(lines), h


def spark_rows(df):
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def duck_rows(con, sql):
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(spark, con, name: str, sf_dir: str, queries, sqls) -> dict:
    t0 = time.time()
    s_cols, s_rows = spark_rows(queries[name](spark, sf_dir))
    t1 = time.time()
    res = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": len(s_rows)}
    if name not in sqls:
        res["status"] = "rows-only"
        return res
    d_cols, d_rows = duck_rows(con, sqls[name])
    sc, sn, sh = digest(s_cols, s_rows)
    dc, dn, dh = digest(d_cols, d_rows)
    res.update(cols_ok=sc == dc, rows_ok=sn == dn, hash_ok=sh == dh)
    res["status"] = "ok" if (sc == dc and sn == dn and sh == dh) else "MISMATCH"
    if res["status"] != "ok":
        res["spark_cols"], res["duck_cols"], res["duck_rows"] = sc, dc, dn
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ls = sorted("|".join(_cell(r[i]) for i in order_s) for r in s_rows)
        ld = sorted("|".join(_cell(r[i]) for i in order_d) for r in d_rows)
        res["only_spark"] = sorted(set(ls) - set(ld))[:3]
        res["only_duck"] = sorted(set(ld) - set(ls))[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from payscope.session import build_session
    spark = build_session(shuffle_partitions=8)
    queries, sqls = E.queries(), E.oracle_sql()
    names = argv[2:] or list(queries)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir, queries, sqls)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": "ERROR", "error": str(e)[:400]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
