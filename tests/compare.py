"""Registered queries against their SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([r[i] for i in order]) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when rows, column names and values agree, else what differs."""
    got_names, got = comparable(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_names, want = comparable([c[0] for c in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g[:600]}\n   != {w[:600]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = contract.oracle_sql()
    for name, query in contract.queries().items():
        if (wanted and name not in wanted) or name not in oracle:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = difference(df, con, oracle[name])
            print(f"{name:28s} {'ok' if found is None else 'DIFFERS ' + found} {time.time() - start:.2f}s", flush=True)
        except Exception as error:  # report and go on with the other queries
            print(f"{name:28s} FAILED {str(error)[:1500]}", flush=True)
