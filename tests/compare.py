"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

    python tests/compare.py [name-prefix ...] [--sf DIR]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
DEFAULT_DIR = "/root/testdata/sf0.01"


def session(cpus: int = 8):
    from wakeline import build_session

    spark = build_session("wakeline-tests", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wakeline-tests-")})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value == int(value) and abs(value) < 1e15 else value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def cut(text, n=900):
    return text if len(text) <= n else text[:n] + "..."


def compare(spark, con, name, folder):
    from wakeline.queries import CHECKS, QUERIES

    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = CHECKS.get(name)
    if sql is None:
        return "rows-only", len(got), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return "schema", len(got), f"spark {sorted(df.columns)} / sql {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return "ok", len(got), None
    return "differ", len(got), cut(f"spark {len(got)} rows, sql {len(want)} rows\n  cols {sorted(names)}\n  only spark: "
                                f"{[str(x)[:300] for x in list((a - b).elements())[:3]]}\n  only sql:   {[str(x)[:300] for x in list((b - a).elements())[:3]]}")


def main(argv):
    from wakeline.queries import QUERIES

    folder = DEFAULT_DIR
    if "--sf" in argv:
        at = argv.index("--sf")
        folder = argv[at + 1]
        argv = argv[:at] + argv[at + 2:]
    names = [n for n in QUERIES if not argv or any(n.startswith(p) for p in argv)]
    spark, con, bad = session(), duck(folder), 0
    for name in names:
        start = time.time()
        try:
            status, n, detail = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            status, n, detail = "error", -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += status not in ("ok", "rows-only") or n == 0
        print(f"{status:9s} {n:8d} {time.time() - start:6.1f}s {name}" + (f"\n  {detail}" if detail else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
