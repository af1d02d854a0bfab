"""Runs registered queries against their oracles. `python tests/compare.py [sf_dir] [name…]`"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("retention")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return (type(value).__name__, value) if value is not None else ("", None)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


def compare(con, sql, df) -> list[str]:
    """Differences between a Spark result and the oracle, empty if equal cell by cell."""
    cur = con.execute(sql)
    want_cols, want = canonical([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if want_cols != got_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
    if len(want) != len(got):
        problems.append(f"{len(got)} rows, oracle has {len(want)}")
    if not problems and want != got:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems


def main() -> int:
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = session(), duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problems = compare(con, sql[name], df) if name in sql else []
            note = "ok" if name in sql else f"rows only: {df.count()}"
        except Exception as e:
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        failed += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s  {'; '.join(problems)[:900] or note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
