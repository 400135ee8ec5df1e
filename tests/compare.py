"""Compare registered queries with their checking SQL.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows]
    return sorted(shaped, key=repr)


def compare(frame, connection, sql):
    """None when equal, else a short account of the difference."""
    relation = connection.sql(sql)
    expected_names, got_names = relation.columns, frame.columns
    if sorted(expected_names) != sorted(got_names):
        return f"columns differ: {sorted(got_names)} / {sorted(expected_names)}"
    got = _rows(got_names, [tuple(r) for r in frame.collect()])
    expected = _rows(expected_names, relation.fetchall())
    if not expected:
        return None if not got else f"{len(got)} rows, none expected"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(got, expected, strict=True) if repr(a) != repr(b)]
    if not wrong:
        return None
    names = sorted(got_names)
    a, b = wrong[0]
    cells = [f"{n}: {x[1]!r} ({x[0]}) / {y[1]!r} ({y[0]})" for n, x, y in zip(names, a, b, strict=True) if x != y]
    return f"{len(wrong)} of {len(got)} rows differ, first: " + "; ".join(cells)


def main(folder, wanted):
    from canteiro import build_session
    from canteiro.queries import REGISTRY

    spark = build_session(
        "compare", master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name, item in REGISTRY.items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = item.build(spark, folder)
            problem = f"rows only: {frame.count()}" if item.sql is None else compare(frame, connection, item.sql)
            if problem is None and not connection.sql(item.sql).limit(1).fetchall():
                print(f"note {name} is empty on this folder", flush=True)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} different", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.001", args[1:])))
