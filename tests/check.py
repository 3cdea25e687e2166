"""Compares registered queries with their DuckDB SQL: python tests/check.py [sf_dir] [query ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


TIMES: dict[str, float] = {}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, int, str]:
    """(equal, rows, message) of one query."""
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    TIMES[name] = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, len(ours), "no SQL"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, len(ours), f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours == theirs:
        return True, len(ours), ""
    a, b = set(ours), set(theirs)
    return False, len(ours), f"{len(ours)}/{len(theirs)} rows; ours {list(a - b)[:2]}; theirs {list(b - a)[:2]}"


if __name__ == "__main__":
    from threadlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    bad = 0
    for query in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            same, count, note = compare(session, db, query, sf)
        except Exception as error:  # report and go on with the next query
            same, count, note = False, -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not same
        print(f"{'ok ' if same and count else 'BAD'} {query:28} {count:7} rows {TIMES.get(query, 0):6.2f}s of {time.time() - start:6.2f}s {note[:1800]}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(entry.queries()) - set(entry.oracle_sql()))}")
