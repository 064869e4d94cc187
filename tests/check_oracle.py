"""Compare every registered query with its DuckDB SQL: python tests/check_oracle.py [sf_dir] [names]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """Message of the first difference, empty when equal; plus row count and seconds."""
    begin = time.perf_counter()
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    spent = time.perf_counter() - begin
    begin = time.perf_counter()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = _rows(columns, result.fetchall())
    oracle_spent = time.perf_counter() - begin
    problem = ""
    if sorted(columns) != sorted(df.columns):
        problem = f"columns {sorted(df.columns)} != {sorted(columns)}"
    elif len(got) != len(want):
        problem = f"rows {len(got)} != {len(want)}"
    else:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        if bad:
            g, w = bad[0]
            names = sorted(columns)
            cells = [(n, a[:150], b[:150]) for n, a, b in zip(names, g, w) if a != b]
            problem = f"{len(bad)} of {len(got)} rows differ, first: {cells[:3]}"
    types = {
        c: (t, kinds[c])
        for c, t in df.dtypes
        if c in kinds and not _same_type(t, kinds[c])
    }
    if types and not problem:
        problem = f"types {types}"
    return problem, len(got), spent, oracle_spent


def _same_type(spark_type: str, duck_type: str) -> bool:
    same = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }
    return same.get(spark_type, spark_type).upper() == duck_type.upper()


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle = entry.oracle_sql()
    failures = 0
    for name, fn in entry.queries().items():
        if chosen and name not in chosen:
            continue
        if name not in oracle:
            begin = time.perf_counter()
            print(f"rows {name:30s} {fn(spark, sf).count():8d} {time.perf_counter() - begin:6.2f}s", flush=True)
            continue
        try:
            problem, n, spent, other = compare(spark, con, name, fn, oracle[name], sf)
        except Exception as error:  # report and go on with the next query
            problem, n, spent, other = f"error {str(error)[:500]}", 0, 0.0, 0.0
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:30s} {n:8d} {spent:6.2f}s {other:6.2f}s {problem}", flush=True)
    print("failures:", failures)
    sys.exit(bool(failures))
