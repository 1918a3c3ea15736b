"""Run registered queries against their SQL twins (also usable as a script)."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", round(v, 9))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return ("f", float(v))
    if hasattr(v, "as_tuple"):
        return ("f", round(float(v), 9))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf, fn, sql):
    """None when equal, else a short text."""
    df = fn(spark, sf)
    sn, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    dn, dr = rows_of([d[0] for d in cur.description], cur.fetchall())
    if sn != dn:
        return f"columns {sn} != {dn}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}; {sr[:2]} / {dr[:2]}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    return f"{len(bad)} of {len(sr)} rows differ: {bad[:2]}" if bad else None


if __name__ == "__main__":
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from demandcast.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        t = time.time()
        try:
            if name in oracles:
                why = compare(spark, con, sf, fn, oracles[name])
            else:
                why = None if fn(spark, sf).count() > 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:700]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{'ok  ' if why is None else 'FAIL'} {name:28s} {time.time() - t:6.2f}s {'' if name in oracles else '(rows only)'} {why or ''}", flush=True)
        if why:
            failed.append(name)
    print("failed:", failed)
