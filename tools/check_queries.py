"""Run registered queries on Spark and compare each with its SQL in DuckDB.

Usage: python tools/check_queries.py [--dir DIR] [--only PREFIX ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def spark_session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").appName("ledgermill")
             .config("spark.sql.shuffle.partitions", cores)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(f"{v:.10g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def compare(spark, con, name, q, sf_dir):
    """Return (ok, message)."""
    df = q.run(spark, sf_dir)
    got_names, got = normal(df.columns, df.collect())
    if q.oracle is None:
        return True, f"rows only: {len(got)}"
    rel = con.execute(q.oracle)
    names, want = normal([c[0] for c in rel.description], rel.fetchall())
    if names != got_names:
        return False, f"columns {got_names} != {names}"
    if got == want:
        return True, f"{len(got)} rows"
    missing = [r for r in want if r not in set(got)][:2] if len(want) < 20000 else want[:2]
    extra = [r for r in got if r not in set(want)][:2] if len(got) < 20000 else got[:2]
    return False, f"{len(got)} vs {len(want)} rows; want {missing} got {extra}"[:1500]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--dir", default="/root/testdata/sf0.01")
    ap.add_argument("--only", nargs="*", default=[])
    args = ap.parse_args()
    from ledgermill.queries.catalog import QUERIES

    spark, con = spark_session(), duck(args.dir)
    bad = []
    for name, q in QUERIES.items():
        if args.only and not any(name.startswith(p) for p in args.only):
            continue
        t = time.time()
        try:
            ok, msg = compare(spark, con, name, q, args.dir)
        except Exception as e:  # report and go on
            ok, msg = False, (str(e)[:900] + "\n" + traceback.format_exc()[-600:])
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - t:6.1f}s {msg}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main()
