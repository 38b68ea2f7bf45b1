"""Run entries in Spark and their SQL in DuckDB and compare all rows.

``python -m checks.compare [sf] [name prefix ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import ENTRIES
from checks.derived import BASE
from claimspark.session import build_session


def same_value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return x


def bag(rows) -> Counter:
    return Counter(tuple(same_value(x) for x in row) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[bool, str]:
    entry = ENTRIES[name]
    started = time.time()
    df = entry.run(spark, sf_dir)
    got_cols = df.columns
    got = bag(df.collect())
    spark_s = time.time() - started
    started = time.time()
    rel = con.execute(entry.sql())
    want_cols = [c[0] for c in rel.description]
    want = bag(rel.fetchall())
    duck_s = time.time() - started
    ok = got == want and got_cols == want_cols
    note = f"{sum(got.values())} rows, spark {spark_s:.1f}s, sql {duck_s:.1f}s"
    if not ok:
        note += f"; want {sum(want.values())}; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
    return ok, note


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    prefixes = argv[1:] or [""]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in ENTRIES:
        if not any(name.startswith(x) for x in prefixes):
            continue
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name, note, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
