"""Run registered queries and compare them with their SQL in DuckDB.

python tools/check_queries.py [--sf sf0.01] [--only prefix ...]
"""

import argparse
import datetime
import decimal
import importlib
import math
import pathlib
import sys
import time
import traceback

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, (int, decimal.Decimal)):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def connect(sf):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def main():
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="sf0.01")
    p.add_argument("--only", nargs="*", default=[])
    p.add_argument("--modules", nargs="*", default=[])
    a = p.parse_args()
    from provatab.cluster import session

    if a.modules:
        for m in a.modules:
            importlib.import_module(f"provatab.plans.{m}")
        from provatab.plans.registry import ORACLE, QUERIES
    else:
        from provatab.plans.all_queries import ORACLE, QUERIES
    sf = f"/root/testdata/{a.sf}"
    spark = session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if a.only and not any(name.startswith(o) for o in a.only):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            got_cols, got = df.columns, df.collect()
            took = time.time() - t
            if name not in ORACLE:
                print(f"rows  {name:40s} {len(got):8d} {took:6.1f}s", flush=True)
                continue
            cur = con.execute(ORACLE[name])
            want_cols = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = cur.fetchall()
            g, w = rows_of(got_cols, got), rows_of(want_cols, want)
            odd = {c: (t, types.get(c)) for c, t in df.dtypes if c in types and not _agree(t, types[c])}
            ok = sorted(got_cols) == sorted(want_cols) and g == w
            bad += not ok
            print(f"{'ok   ' if ok else 'DIFF '} {name:40s} {len(got):8d} {took:6.1f}s {'TYPES ' + str(odd) if odd else ''}", flush=True)
            if not ok:
                print("   columns", sorted(got_cols), sorted(want_cols))
                gs, ws = set(g), set(w)
                print("   n", len(g), len(w), "only spark", list(gs - ws)[:3], "only sql", list(ws - gs)[:3])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name:40s} {type(e).__name__} {str(e)[:700]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
    print("bad", bad)
    spark.stop()


def _agree(spark_type, duck_type):
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
    return pairs.get(spark_type, spark_type) == duck_type


main()
