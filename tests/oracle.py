"""Run registered queries beside their SQL twins and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, datetime.date):
        return datetime.datetime(value.year, value.month, value.day)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(con, spark, sf_dir: str, fn, sql: str | None):
    """(ok, message)"""
    started = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    took = time.time() - started
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no twin, {took:.1f}s"
    started = time.time()
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want_cols, want = rows_of(columns, res.fetchall())
    other = time.time() - started
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got != want:
        left, right = set(got), set(want)
        extra, lack = sorted(left - right, key=repr)[:3], sorted(right - left, key=repr)[:3]
        return False, f"{len(got)} rows != {len(want)}; only here {extra}; only there {lack}"
    return len(got) > 0, f"{len(got)} rows equal, {took:.1f}s (twin {other:.1f}s)"


if __name__ == "__main__":
    import importlib

    from lexshelf.session import local_session

    entry = importlib.import_module("__spark_entry__")
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = local_session()
    con = database(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, message = compare(con, spark, sf_dir, fn, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(("ok  " if ok else "BAD ") + name + ": " + message, flush=True)
    print("failed:", bad)
