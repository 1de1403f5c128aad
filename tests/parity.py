"""Runs registered queries next to their SQL and compares the results value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, decimal.Decimal):
        return plain(float(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, run, sql: str, sf_dir: str) -> str:
    df = run(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    theirs = relation.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows differ: {len(mine)} / {len(theirs)}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} values differ, e.g.\n  {bad[0][0]}\n  {bad[0][1]}"
    return "" if a else "empty"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from rivulet.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, con = local_session("8"), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                note = compare(spark, con, run, oracles[name], sf_dir)
            else:
                note = "" if run(spark, sf_dir).count() else "empty"
        except Exception as error:
            note = f"{type(error).__name__}: {str(error)[:700]}"
        kind = "sql " if name in oracles else "rows"
        failed += bool(note)
        if note or wanted or os.environ.get("VERBOSE"):
            print(f"{'BAD' if note else 'ok '} {kind} {time.time() - start:6.2f}s {name} {note}", flush=True)
    print(f"{failed} failed of {len(queries)}; {len(oracles)} with SQL")
    spark.stop()


if __name__ == "__main__":
    main()
