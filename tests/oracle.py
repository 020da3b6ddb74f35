"""Run registered queries against their SQL twins: ``python tests/oracle.py [sf dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    spent = time.time() - start
    result = {"name": name, "rows": len(got), "sec": round(spent, 2), "ok": None}
    if sql is None:
        return result
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return {**result, "ok": False, "why": f"columns {df.columns} against {names}"}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return {**result, "ok": False, "why": f"{len(a)} rows against {len(b)}", "first": (a[:2], b[:2])}
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return {**result, "ok": False, "why": f"{len(bad)} rows differ", "first": bad[0]}
    return {**result, "ok": True}


if __name__ == "__main__":
    from quadrivium.session import local_session
    from quadrivium.workloads import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf)
    todo, sqls = queries(), oracle_sql()
    bad = 0
    for name in wanted or todo:
        try:
            r = compare(spark, con, name, todo[name], sqls.get(name), sf)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:1500]}"}
        bad += r["ok"] is False
        print(r["ok"], r["name"], r.get("rows"), r.get("sec"), r.get("why", ""), str(r.get("first", ""))[:1500], flush=True)
    print("failed:", bad)
