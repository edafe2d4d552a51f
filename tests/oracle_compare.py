"""Run a registered query on Spark and its SQL twin on DuckDB; compare."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, Decimal):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE", "binary": "BLOB",
}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark, name: str, sf_dir: str, query, sql: str, con=None):
    """Returns (ok, message). Columns are matched by name (with equivalent
    types); rows as multisets."""
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t).replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    d_rows = [tuple(_norm(v) for _, v in sorted(zip(d_cols, r))) for r in rel.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if s_types != d_types:
        diff = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types.get(c)}
        return False, f"{name}: column types differ {diff}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"{name}: first differing row\n spark={x}\n duck ={y}\n cols={sorted(s_cols)}"
    return True, f"{name}: {len(s_rows)} rows match"


def main(argv=None) -> int:
    """``python tests/oracle_compare.py [SF_DIR] [QUERY ...]``: run every
    registered query (or the named ones) against its SQL twin."""
    import os
    import sys
    import time

    argv = sys.argv[1:] if argv is None else argv
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from ledgerspark.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session(master="local[*]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        if name not in oracle:
            n = query(spark, sf_dir).count()
            print(f"--  {name}: {n} rows (no SQL twin)")
            continue
        try:
            ok, msg = compare(spark, name, sf_dir, query, oracle[name], con)
        except Exception as exc:  # report and go on
            ok, msg = False, f"{name}: {type(exc).__name__}: {exc}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {msg} ({time.perf_counter() - t0:.2f}s)", flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
