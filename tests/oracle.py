"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py [sf] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("orders", "lineitem", "part", "supplier", "embeddings", "documents")


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str) -> tuple[bool, int, int, float]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    want = canonical(cur.fetchall(), cols)
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    same = sorted(cols) == sorted(df.columns) and got == want
    return same, len(got), len(want), time.time() - began


if __name__ == "__main__":
    from quadrille.session import session

    spark = session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    for query in sys.argv[2:] or entry.oracle_sql():
        same, got, want, sec = compare(spark, f"/root/testdata/sf{sf}", query)
        print("ok  " if same else "DIFF", query, got, want, f"{sec:.2f}s", flush=True)
