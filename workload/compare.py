"""Run registered queries next to their SQL: python -m workload.compare [sf_dir] [name ...]"""

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (datetime, date)):
        return str(value).replace("+00:00", "")
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf, name, queries, sql):
    started = time.time()
    frame = queries[name](spark, sf)
    got = frame.collect()
    seconds = time.time() - started
    if name not in sql:
        return f"rows-only {len(got)} rows", seconds
    result = con.execute(sql[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"COLUMNS {sorted(frame.columns)} {sorted(columns)}", seconds
    a, b = rows_of(frame.columns, got), rows_of(columns, want)
    if a == b:
        return f"ok {len(a)} rows", seconds
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"DIFF {len(a)} {len(b)}\n  spark {str(only_a)[:900]}\n  sql   {str(only_b)[:900]}", seconds


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf, name)}.parquet'")
    return con


def main(args):
    from callscope.session import build_session
    import workload.streams  # noqa: F401
    from workload.registry import QUERIES, SQL

    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        try:
            verdict, seconds = compare(spark, con, sf, name, QUERIES, SQL)
        except Exception as error:
            verdict, seconds = f"ERROR {str(error)[:1500]}", 0
        print(f"@@ {name}: {verdict} ({seconds:.1f}s)", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
