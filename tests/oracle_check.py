"""Run registered queries in Spark and their DuckDB twins; compare like the driver does
(row count, column names, order-insensitive values).  Usable as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    scols, srows = rows_of(sdf.columns, [tuple(r) for r in srows])
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols, drows = rows_of(list(rel.columns), rel.fetchall())
    res["duck_rows"] = len(drows)
    if scols != dcols:
        res["status"] = f"COLUMNS {scols} vs {dcols}"
    elif len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
    elif srows != drows:
        bad = [(a, b) for a, b in zip(srows, drows) if a != b]
        res["status"] = f"VALUES {len(bad)} differ; first: {bad[0]}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from quarry.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(names or qs) - bad} good, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
