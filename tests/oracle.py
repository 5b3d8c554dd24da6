"""Compare queries with their SQL on the test tables: python tests/oracle.py [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return f"{type(v).__name__}:{v}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    have_cols, have = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(have) != len(want):
        return f"{len(have)} rows, expected {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            diff = difference(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        ok = diff is None or diff.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.2f}s {diff or ''}", flush=True)
    print("failed:", bad)
    spark.stop()
