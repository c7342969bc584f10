"""Run a registered query next to its DuckDB oracle and compare results
order-insensitively (row count, column names, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name, build, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = build(spark, sf_dir)
    scols = sdf.columns
    compare.last_plan = sdf._jdf.queryExecution().executedPlan().toString()
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = _rows(scols, srows), _rows(dcols, drows)
    ok = ok_cols and a == b
    detail = ""
    if not ok:
        if not ok_cols:
            detail = f"columns spark={sorted(scols)} duck={sorted(dcols)}"
        else:
            sa, sb = set(a), set(b)
            detail = (f"rows spark={len(a)} duck={len(b)}; only spark: {list(sa - sb)[:3]}; "
                      f"only duck: {list(sb - sa)[:3]}")
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from gleaner.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            t0 = time.time()
            n = build(spark, sf_dir).count()
            print(f"-- {name:32s} rows={n} (no oracle) {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            ok, n, secs, detail = compare(spark, name, build, oracle[name], sf_dir, con)
        except Exception as exc:  # report and continue with the next query
            ok, n, secs, detail = False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK' if ok else 'XX'} {name:32s} rows={n} {secs:.1f}s {detail}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
