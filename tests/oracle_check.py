"""Run registered queries against their DuckDB oracle, as the driver does.

Usage: python tests/oracle_check.py [--plain] [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from obsflow.session import get_spark  # noqa: E402
from obsflow.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    text = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(text), [cols[i] for i in order], hashlib.sha256("\n".join(text).encode()).hexdigest()[:16]


def spark_rows(df):
    return list(df.columns), [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def main():
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:]
    if "--plain" in sys.argv:  # a bare session, as an outside caller would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = get_spark("local[8]", shuffle_partitions=8,
                          extra_conf={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            scols, srows = spark_rows(qs[k](spark, sf_dir))
        except Exception as exc:  # noqa: BLE001
            print(f"{k:28s} SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in oracle:
            print(f"{k:28s} rows-only  spark={len(srows)}  {ts:.1f}s")
            continue
        try:
            ocols, orows = duck_rows(con, oracle[k])
        except Exception as exc:  # noqa: BLE001
            print(f"{k:28s} ORACLE ERROR {str(exc)[:300]}")
            bad += 1
            continue
        a, b = digest(scols, srows), digest(ocols, orows)
        ok = a == b
        bad += not ok
        print(f"{k:28s} {'OK ' if ok else 'MISMATCH'} spark={a[0]} oracle={b[0]} {ts:.1f}s"
              + ("" if ok else f"\n    cols {a[1]} vs {b[1]}"))
        if not ok and a[1] == b[1]:
            sdf = pd.DataFrame([[_norm(v) for v in r] for r in srows], columns=scols)
            odf = pd.DataFrame([[_norm(v) for v in r] for r in orows], columns=ocols)[scols]
            m = sdf.merge(odf, how="outer", indicator=True)
            print(m[m["_merge"] != "both"].head(6).to_string()[:2000])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
