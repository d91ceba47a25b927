"""Run registered queries beside their SQL checks and compare whole results.

Command line: ``python tests/parity.py [sf_dir] [name-part …]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def reference(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("%r" % (value + 0.0))
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(sorted(names), g, w) if a != b]
        return f"{len(bad)} of {len(want)} rows differ, first: {cells[:6]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from millwright.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("parity", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = reference(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, query, sqls[name], sf)
            else:
                n = query(spark, sf).count()
                problem = None if n else "no rows"
        except Exception as error:  # a report over all queries goes on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "ok  " if problem is None else "FAIL"
        print(f"{kind} {time.time() - start:6.2f}s {name} {'' if name in sqls else '(rows only)'} {problem or ''}", flush=True)
    print(f"failed: {failed}")
