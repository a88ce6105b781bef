"""Run every registered query and its check SQL side by side and report differences.

Usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from caseworks.session import local_session  # noqa: E402
from caseworks.workload import domain, registry  # noqa: E402


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, dt.datetime):
        return ("t", value.isoformat())
    if isinstance(value, dt.date):
        return ("day", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in domain.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = [n for a in args[1:] for n in registry.queries() if n.startswith(a)]
    spark = local_session("8", "compare", **{"spark.driver.memory": "12g", "spark.driver.maxResultSize": "8g"})
    con = connect(sf_dir)
    checks, bad = registry.oracle_sql(), 0
    for name, query in registry.queries().items():
        if args[1:] and name not in wanted:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            got = rows(df.columns, df.collect())
            took = time.time() - started
            if name not in checks:
                print(f"rows  {name}: {sum(got.values())} rows, {took:.2f}s", flush=True)
                continue
            cursor = con.execute(checks[name])
            names = [c[0] for c in cursor.description]
            want = rows(names, cursor.fetchall())
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {str(error)[:900]}", flush=True)
            continue
        if sorted(names) != sorted(df.columns):
            bad += 1
            print(f"FAIL  {name}: columns {sorted(set(names) ^ set(df.columns))}", flush=True)
        elif got != want:
            bad += 1
            extra, missing = got - want, want - got
            print(f"FAIL  {name}: {sum(got.values())} vs {sum(want.values())} rows", flush=True)
            print("   only spark ", list(extra)[:1], "\n   only duckdb", list(missing)[:1])
            if extra and missing:
                a, b = min(extra, key=str), min(missing, key=str)
                print("   differing:", [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y][:6])
        else:
            print(f"ok    {name}: {sum(got.values())} rows, {took:.2f}s", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
