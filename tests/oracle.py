"""Runs registered queries beside their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, registered, allow_empty=False):
    """None when equal, else what differs."""
    df = registered.run(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if registered.sql is None:
        return None if got[1] else "no rows"
    cursor = con.execute(registered.sql)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    if not got[1] and not allow_empty:
        return "no rows"
    for g, w in zip(got[1], want[1]):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{got[0]}\n got {g}\nwant {w}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from rillflow.queries import all_queries
    from rillflow.session import build_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    session = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name, registered in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(session, con, sf, registered)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'sql' if registered.sql else '---'} {'ok' if problem is None else 'FAIL ' + problem}", flush=True)
    print("failed", bad)
