"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trialmill.plans import catalog  # noqa: E402
from trialmill.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return round(value, 5) + 0.0 if value == value else None
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if value is None or isinstance(value, (bool, int, str)) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def compare(spark, con, sf_dir, name):
    start = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    took = time.time() - start
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return None, len(mine[1]), took, ""
    result = con.execute(sql)
    other = rows_of([c[0] for c in result.description], result.fetchall())
    if mine == other:
        return True, len(mine[1]), took, ""
    if mine[0] != other[0]:
        return False, len(mine[1]), took, f"columns {mine[0]} != {other[0]}"
    only_mine = sorted(set(mine[1]) - set(other[1]), key=repr)[:2]
    only_other = sorted(set(other[1]) - set(mine[1]), key=repr)[:2]
    return False, len(mine[1]), took, f"{mine[0]} rows {len(mine[1])}/{len(other[1])}\n  spark {only_mine}\n  sql   {only_other}"


if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    session = build_session(8)
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    chosen = [n for n in catalog.queries() if not names or any(n.startswith(x) for x in names)]
    for query in chosen:
        try:
            ok, n, seconds, note = compare(session, connection, folder, query)
        except Exception as e:  # noqa: BLE001
            ok, n, seconds, note = "ERROR", 0, 0.0, str(e)[:1500]
        print({True: "ok  ", False: "DIFF", None: "rows"}.get(ok, ok), query, n, f"{seconds:.2f}s", note, flush=True)
