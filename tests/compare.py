"""Run registered queries next to their SQL in DuckDB and compare the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value: object) -> object:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def normalise(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Why the two results differ, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = normalise(names, result.fetchall())
    got = normalise(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(want)} rows differ, such as {bad[0]}" if bad else None


def main() -> int:
    from pyspark.sql import SparkSession

    from tabkit.catalog import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = mismatch(df, con, ORACLES[name])
                verdict = problem or "same"
            else:
                problem = None
                verdict = f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on
            problem = verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:25}{time.time() - start:7.2f}s  {verdict}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
