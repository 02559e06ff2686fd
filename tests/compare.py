"""Compare registered queries with their SQL twins: columns, kinds, row counts and values.

Run as a script to check some or all queries: ``python tests/compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(spark_type):
    text = spark_type.simpleString()
    return {"timestamp_ntz": "timestamp", "string": "varchar"}.get(text, text)


def duck_kind(duck_type):
    text = str(duck_type).lower()
    return {"integer": "int"}.get(text, text)


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(spark, con, query, sql, sf_dir):
    """A list of differences; empty when both sides agree."""
    df = query(spark, sf_dir)
    rows = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: duck_kind(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        mine, other = kind(field.dataType), kinds[field.name]
        if mine != other:
            problems.append(f"type of {field.name}: {mine} against {other}")
    order = sorted(names)
    left = sorted(tuple(plain(row[c]) for c in order) for row in rows)
    at = [names.index(c) for c in order]
    right = sorted(tuple(plain(row[i]) for i in at) for row in expected)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        extra, missing = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        problems.append(f"values {order}: {extra} against {missing}")
    return problems


def main(argv):
    import __spark_entry__ as entry
    from geomosaic.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(entry.queries())
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problems = [] if entry.queries()[name](spark, sf_dir).count() >= 0 else ["?"]
                state = "rows only"
            else:
                problems = compare(spark, con, entry.queries()[name], sql, sf_dir)
                state = "ok"
        except Exception as problem:  # noqa: BLE001
            problems, state = [f"{type(problem).__name__}: {str(problem)[:700]}"], "error"
        hard = [p for p in problems if not p.startswith("type of")]
        bad += bool(hard)
        print(f"{'FAIL' if hard else state:9} {time.time() - began:6.2f}s {name} {' | '.join(problems)}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
