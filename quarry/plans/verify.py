"""Local correctness check: each query against its DuckDB oracle.

Mirrors the driver's comparison (row count, column names, order-insensitive
value multiset).  Usage: ``python -m quarry.plans.verify [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from quarry.sources.tables import TABLES


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
            return "nan"
        return round(v, 10) + 0.0  # beyond the queries' own rounding (4 to 10 digits)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


# Spark simple type names -> DuckDB type names (for the schema comparison)
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def type_mismatches(sdf, rel) -> list:
    st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return [(c, st[c], dt.get(c)) for c in st if SPARK_TO_DUCK.get(st[c], st[c]) != dt.get(c)]


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


def compare(spark, sf_dir: str, names=None) -> dict:
    import importlib
    entry = importlib.import_module("__spark_entry__")
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols, srows = rows_of_spark(sdf)
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        dt = time.time() - t0
        if name not in sql:
            out[name] = f"rows-only n={sum(srows.values())} ({dt:.1f}s)"
            continue
        try:
            dcols, drows = rows_of_duck(con, sql[name])
        except Exception as e:  # noqa: BLE001
            out[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        n_s, n_d = sum(srows.values()), sum(drows.values())
        if scols != dcols:
            out[name] = f"SCHEMA spark={scols} duck={dcols}"
        elif srows != drows:
            diff = list((srows - drows).items())[:3], list((drows - srows).items())[:3]
            out[name] = f"VALUES n={n_s}/{n_d} spark-only/duck-only={diff}"
        else:
            bad = type_mismatches(sdf, con.sql(sql[name]))
            out[name] = f"OK n={n_s} ({dt:.1f}s)" if not bad else f"TYPES {bad}"
    return out


if __name__ == "__main__":
    from quarry.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    for k, v in res.items():
        print(f"{k:24s} {v}")
