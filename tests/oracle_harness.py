"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive values). Usage:

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sp = fn(spark, sf_dir).toPandas()
    ts = time.time() - t
    dk = con.execute(sql).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(dk)
    ok = sc == dc and sr == dr
    msg = f"{'OK  ' if ok else 'FAIL'} {name}: spark {len(sp)} rows ({ts:.1f}s), duckdb {len(dk)} rows"
    if sc != dc:
        msg += f"\n   columns differ: {sc} vs {dc}"
    elif sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        msg += f"\n   only spark: {only_s}\n   only duckdb: {only_d}"
    types = {c: (str(sp[c].dtype), str(dk[c].dtype)) for c in sc if c in dk.columns
             and str(sp[c].dtype) != str(dk[c].dtype)}
    if types:
        msg += f"\n   dtypes: {types}"
    print(msg, flush=True)
    return ok


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from nextclick import get_spark
    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, sql in sqls.items():
        if names and name not in names:
            continue
        try:
            bad += not compare(spark, con, name, qs[name], sql, sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERR  {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
