"""Runs a query on Spark and its SQL on DuckDB over the same files, and compares the rows.

As a script: ``python tests/oracle.py SF [name-part ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Significant digits of doubles that are compared; 17 is every bit.
DIGITS = int(os.environ.get("ORACLE_DIGITS", "9"))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(v):
    """A comparable form that keeps types apart but not the last bits of a double."""
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, Decimal):
        return ("decimal", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("float", "nan") if math.isnan(v) else ("float", float(f"{v:.{DIGITS}g}") + 0.0)
    if isinstance(v, datetime):
        return ("datetime", v.replace(tzinfo=None))
    if isinstance(v, date):
        return ("date", v)
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and a SQL result; empty when they agree."""
    cursor = con.execute(sql)
    want_columns, want = bag([d[0] for d in cursor.description], cursor.fetchall())
    have_columns, have = bag(df.columns, [tuple(r) for r in df.collect()])
    if want_columns != have_columns:
        return [f"columns: spark {have_columns}, sql {want_columns}"]
    problems = []
    if want != have:
        extra, missing = have - want, want - have
        problems.append(
            f"rows: spark {sum(have.values())}, sql {sum(want.values())}; "
            f"only spark {sum(extra.values())}: {list(extra)[:2]}; only sql {sum(missing.values())}: {list(missing)[:2]}"
        )
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tillstar.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    parts = sys.argv[2:]
    spark = build_session("oracle", master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = compare(build(spark, sf_dir), con, sqls[name])
            else:
                problems = [] if build(spark, sf_dir).count() >= 0 else ["no rows"]
        except Exception as e:  # a report of every query is wanted
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s {'' if name in sqls else '(no sql)'}")
        for p in problems:
            print("    ", p)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
