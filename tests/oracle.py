"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle.py [sf_dir] [name-substring ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) if not isinstance(x, tuple) else (False, "t", str(x))
                 for x in row)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, verbose=True):
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    dtypes = [str(d[1]) for d in rel.description]
    t2 = time.time()
    problems = []
    scols = sdf.columns
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={scols} duck={dcols}")
    else:
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dmap = dict(zip(dcols, dtypes))
        for c in scols:
            st = SPARK_TO_DUCK.get(stypes[c], stypes[c])
            if st != dmap[c] and not (stypes[c].startswith("array") and dmap[c].endswith("[]")):
                problems.append(f"type {c}: spark={stypes[c]} duck={dmap[c]}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
        d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
        if len(s) != len(d):
            problems.append(f"row count spark={len(s)} duck={len(d)}")
        diff = [(a, b) for a, b in zip(s, d) if a != b]
        if diff:
            problems.append(f"{len(diff)} differing rows, e.g. spark={diff[0][0]} duck={diff[0][1]}")
    if verbose:
        status = "OK " if not problems else "BAD"
        print(f"{status} {name:32s} rows={len(srows):7d} spark={t1 - t0:6.2f}s duck={t2 - t1:5.2f}s "
              + ("; ".join(problems)[:600] if problems else ""), flush=True)
    return problems


def main():
    from quarry.session import build_session
    from quarry.plans import REGISTRY
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session("local[8]")
    con = duck_connect(sf_dir)
    bad = []
    for name, q in REGISTRY.items():
        if pats and not any(p in name for p in pats):
            continue
        if not q.sql:
            t0 = time.time()
            try:
                n = q.fn(spark, sf_dir).count()
                print(f"ROW {name:32s} rows={n:7d} spark={time.time() - t0:6.2f}s", flush=True)
            except Exception as e:  # noqa: BLE001
                print(f"ERR {name:32s} {type(e).__name__}: {str(e)[:400]}", flush=True)
                bad.append(name)
            continue
        try:
            if compare(spark, name, q.fn, q.sql, sf_dir, con):
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name:32s} {type(e).__name__}: {str(e)[:600]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
