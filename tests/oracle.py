"""Side-by-side run of a registered query and its SQL.

python tests/oracle.py [--hot] [folder] [name or part of a name ...]

With --hot the limits are set so low that every group is hot and nothing is broadcast.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:10]
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, folder: str, queries, sql) -> tuple[str, int]:
    """'' and the row count if both sides agree, else what differs."""
    df = queries[name](spark, folder)
    got_columns, got = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in sql:
        return "", sum(got.values())
    cur = con.execute(sql[name])
    want_columns, want = table([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}", 0
    if got != want:
        extra, missing = list((got - want).elements()), list((want - got).elements())
        shown = []
        for g, w in list(zip(sorted(extra, key=str), sorted(missing, key=str)))[:2]:
            shown += [f"{c}: {a!r} / {b!r}" for c, a, b in zip(got_columns, g, w) if a != b or c == "uid"]
        return f"{len(extra)} extra, {len(missing)} missing of {sum(want.values())}: " + "; ".join(shown[:12]), 0
    return "", sum(got.values())


HOT = {"tallyloom.groupRows": "5"}


def set_hot(spark, on: bool = True) -> None:
    for name, value in HOT.items():
        spark.conf.set(name, value) if on else spark.conf.unset(name)


def main() -> int:
    import __spark_entry__ as entry
    from tallyloom.session import build_session

    args = [a for a in sys.argv[1:] if a != "--hot"]
    folder = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark, con = build_session("oracle", 8), connect(folder)
    if "--hot" in sys.argv:
        set_hot(spark)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, name, folder, queries, sql)
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:900]}", 0
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in sql else "rows")
        print(f"{mark:5}{name:32}{n:9} rows {time.time() - start:6.2f} s  {problem}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
