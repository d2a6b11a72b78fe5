"""Runs registered queries beside their SQL twins; ``python tests/compare.py [sf] [name part ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return "∅"
    if isinstance(value, float):
        if math.isnan(value):
            return "∅"
        return repr(value) if value != int(value) else str(int(value))
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "item"):
        return cell(value.item())
    return str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in records)


def compare(spark, con, folder, name, fn, sql):
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return len(got), ""
    extra = [r for r in got if r not in set(want)][:2]
    lost = [r for r in want if r not in set(got)][:2]
    return len(got), f"rows {len(got)} vs {len(want)}; only spark {str(extra)[:700]}; only sql {str(lost)[:700]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from siftline.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(folder), entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in queries.items():
        if args[1:] and not any(name.startswith(a) for a in args[1:]):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, folder, name, fn, sql.get(name))
        except Exception as exc:  # a failing query must not hide the others
            n, problem = 0, f"ERROR {str(exc)[:900]}"
        state = "rows-only" if problem is None else "ok" if not problem else "BAD"
        print(f"{state:9s} {name:34s} {n:7d} {time.time() - start:6.2f}s {'' if state != 'BAD' else problem}", flush=True)
        if state == "BAD":
            bad.append(name)
    print("bad:", bad)
