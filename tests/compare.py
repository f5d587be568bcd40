"""Run registered queries against their SQL twins and report every difference.

``python -m tests.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPE_NAMES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "bool", int(v)) for v in row)


def compare(df, con, sql: str) -> list[str]:
    problems = []
    cur = con.execute(sql)
    sql_cols = [d[0] for d in cur.description]
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    sql_rows = cur.fetchall()
    names = sorted(df.columns)
    if names != sorted(sql_cols):
        return [f"columns: spark-only {sorted(set(names) - set(sql_cols))} sql-only {sorted(set(sql_cols) - set(names))}"]
    for name, kind in df.dtypes:
        if TYPE_NAMES.get(kind) != sql_types[name]:
            problems.append(f"type {name}: spark {kind} sql {sql_types[name]}")
    order = [sql_cols.index(n) for n in names]
    ours = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in sql_rows), key=sort_key)
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)} sql {len(theirs)}")
    if not ours:
        problems.append("note: no rows")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        a, b = bad[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(bad)} rows differ, first: {diff} of {dict(zip(names, a))}")
    return problems


def main(argv: list[str]) -> int:
    from shelfline.session import local_session
    import __spark_entry__ as e

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = connect(sf)
    queries, oracle = e.queries(), e.oracle_sql()
    names = argv[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            problems = compare(df, con, oracle[name]) if name in oracle else [f"note: rows only, {df.count()} rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        real = [p for p in problems if not p.startswith("note")]
        failed += bool(real)
        print(f"{'FAIL' if real else 'ok  '} {name} {time.time() - start:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
