"""Run registered queries against their SQL twins in DuckDB: ``python tests/compare.py [names]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{folder}/{name}.parquet')")
    return con


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(spark, con, build, sql, folder) -> str:
    """Empty if both sides agree on columns, row count and values."""
    df = build(spark, folder)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=key)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=key)
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ in {names}, first {bad[0]}" if bad else ""


def main(names, folder="/root/testdata/sf0.01"):
    from demandloom.catalog import ORACLES, QUERIES

    spark, con = session(), database(folder)
    failed = []
    for name in names or QUERIES:
        began = time.time()
        try:
            if name in ORACLES:
                problem = differences(spark, con, QUERIES[name], ORACLES[name], folder)
            else:
                problem = "" if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as exc:
            text = "".join(traceback.format_exception_only(exc))
            problem = "error " + text[:900]
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} [{kind}] {time.time() - began:.1f}s {problem}", flush=True)
        if problem:
            failed.append(name)
    print(len(failed), "failed:", *failed)


if __name__ == "__main__":
    main(sys.argv[1:], os.environ.get("DATA", "/root/testdata/sf0.01"))
