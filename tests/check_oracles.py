"""Compare every registered query with its SQL: python tests/check_oracles.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    frame = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return None, len(got), frame.dtypes
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    same = sorted(columns) == sorted(frame.columns) and canonical(frame.columns, got) == canonical(columns, want)
    if not same:
        a, b = canonical(frame.columns, got), canonical(columns, want)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        print("   ", sorted(columns), sorted(frame.columns), len(a), len(b), diff)
    types = [(d[0], str(d[1])) for d in cur.description]
    return same, len(got), (frame.dtypes, types)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in names:
        start = time.time()
        try:
            same, n, types = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            same, n, types = False, 0, str(error)[:1500]
        print(f"{name:24s} {'rows only' if same is None else 'ok' if same else 'DIFFERENT'} {n} rows {time.time() - start:.2f} s", types if same is not True else "", flush=True)
        if same is False:
            bad.append(name)
    print("bad:", bad)
    sys.exit(bool(bad))
