"""Compare a registered Spark check with its DuckDB oracle.

Row count, column names, column types (normalised) and an order-insensitive
hash of the values (columns sorted by name, doubles rounded to 9 digits).

Usage: ``python -m orderdesk.plans.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

from ..sources.tables import BASE_TABLES
from . import registry


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, (_dt.datetime,)):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for ln in lines:
        h.update(ln.encode())
    return h.hexdigest()[:16]


SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
               "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT",
               "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "tinyint": "TINYINT"}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    if t.startswith("array"):
        return "ARRAY"
    return SPARK_TYPES.get(t, t.upper())


def duck_type(t: str) -> str:
    t = str(t).upper().replace(" ", "")
    if t.endswith("[]"):
        return "ARRAY"
    return t


def compare(spark, name: str, sf_dir: str, con=None, verbose=True) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = registry.run(spark, name, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols = df.columns
    stypes = {c: spark_type(t) for c, t in df.dtypes}
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = registry.oracle(name)
    if sql is None:
        res["oracle"] = None
        return res
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = {c: duck_type(t) for c, t in zip(dcols, rel.types)}
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    res["cols_match"] = sorted(scols) == sorted(dcols)
    res["types_match"] = stypes == dtypes
    res["hash_match"] = digest(scols, srows) == digest(dcols, drows)
    res["ok"] = res["cols_match"] and res["types_match"] and res["hash_match"] and len(srows) == len(drows)
    if verbose and not res["ok"]:
        if not res["cols_match"]:
            res["cols"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        if not res["types_match"]:
            res["types"] = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                            if stypes.get(c) != dtypes.get(c)}
        if not res["hash_match"] and res["cols_match"]:
            order = sorted(range(len(scols)), key=lambda i: scols[i])
            dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
            sset = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in srows)
            dset = sorted(repr(tuple(_norm(r[i]) for i in dorder)) for r in drows)
            from collections import Counter
            sc, dc = Counter(sset), Counter(dset)
            res["only_spark"] = list((sc - dc).elements())[:3]
            res["only_duck"] = list((dc - sc).elements())[:3]
            res["sorted_cols"] = sorted(scols)
    return res


def main(argv):
    from ..session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    registry.load_all()
    names = argv[2:] or list(registry.CHECKS)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:600]}
        ok = r.get("ok", r.get("oracle", "x") is None and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv)
