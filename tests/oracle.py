"""Run registered queries on Spark and their check SQL on DuckDB and compare every row.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"DECIMAL {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return repr(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows])


def compare(spark, con, name, function, sql, sf_dir):
    """None when equal, else a description of the first difference."""
    df = function(spark, sf_dir)
    got = table_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}; e.g. {got[1][:2]} / {want[1][:2]}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(got[1])} rows differ: {got[0]} {bad[0]}" if bad else None


def main(argv):
    from zonalis.queries import ALL, CHECKS
    from zonalis.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf_dir = argv[at + 1]
        argv = argv[:at] + argv[at + 2:]
    names = argv or list(ALL)
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            if name in CHECKS:
                problem = compare(spark, con, name, ALL[name], CHECKS[name], sf_dir)
                outcome = "ok" if problem is None else f"DIFF {problem}"
            else:
                n = len(ALL[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
                outcome = f"rows {n}"
        except Exception as e:  # report and go on with the next query
            problem = outcome = f"ERROR {type(e).__name__} {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {outcome[:1500]}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
