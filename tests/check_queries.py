"""Compare registered queries with their SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402


def plain(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(sf, sql):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    return sorted(names), rows, {d[0]: str(d[1]) for d in cur.description}


def compare(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    got = spark_rows(df)
    if name not in entry.oracle_sql():
        return None, got, None
    names, rows, types = duck_rows(sf, entry.oracle_sql()[name])
    return (got == (names, rows)), got, (names, rows, types, dict(df.dtypes))


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    bad = []
    for n in names:
        t = time.time()
        try:
            ok, got, want = compare(spark, sf, n)
        except Exception as e:  # report and go on
            print(f"ERROR {n} {str(e)[:1500]}", flush=True)
            bad.append(n)
            continue
        print(f"{'ok' if ok else 'NO SQL' if ok is None else 'DIFF'} {n} rows={len(got[1])} {time.time() - t:.1f}s", flush=True)
        if want is not None:
            duck = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}
            odd = {c: (v, want[3].get(c)) for c, v in want[2].items() if duck.get(v, v) != want[3].get(c)}
            if odd:
                print("   types", odd)
        if ok is False:
            bad.append(n)
            a, b = set(got[1]), set(want[1])
            print("   names", got[0], want[0], "rows", len(got[1]), len(want[1]))
            print("   spark only", str(sorted(a - b, key=repr)[:3])[:700])
            print("   sql only  ", str(sorted(b - a, key=repr)[:3])[:700])
    print("BAD", bad)
