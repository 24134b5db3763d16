"""Runs registered queries in Spark and in DuckDB and compares rows, types and values.

``python -m tests.compare [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _family(value: object) -> str:
    """Types that a comparison must tell apart."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (float, Decimal)):
        return "real"
    if isinstance(value, datetime):
        return "timestamp"
    if isinstance(value, date):
        return "date"
    return type(value).__name__


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns: list[str], rows: list[tuple]) -> tuple[Counter, dict[str, set[str]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kinds: dict[str, set[str]] = {columns[i]: set() for i in order}
    bag: Counter = Counter()
    for row in rows:
        for i in order:
            kinds[columns[i]].add(_family(row[i]))
        bag[tuple(_plain(row[i]) for i in order)] += 1
    return bag, {c: k - {"null"} for c, k in kinds.items()}


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_kinds = _rows(names, cursor.fetchall())
    got, got_kinds = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    odd = {
        c: (got_kinds[c], want_kinds[c])
        for c in got_kinds
        if got_kinds[c] and want_kinds[c] and got_kinds[c] != want_kinds[c]
    }
    if odd:
        return f"types differ: {odd}"
    if got != want:
        extra, lost = got - want, want - got
        return (
            f"rows {got.total()} vs {want.total()}, {extra.total()} only in Spark e.g. "
            f"{list(extra)[:2]}, {lost.total()} only in SQL e.g. {list(lost)[:2]}"
        )
    return ""


def main(args: list[str]) -> int:
    from tests.session import local_session
    from workload.queries import REGISTRY

    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark: SparkSession = local_session()
    con = connect(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if q.sql is None:
                verdict = "" if q.run(spark, sf_dir).count() > 0 else "no rows"
            else:
                df = q.run(spark, sf_dir)
                verdict = compare(df, con, q.sql)
                if not verdict and df.isEmpty():
                    verdict = "agrees, but on no rows"
        except Exception as problem:  # noqa: BLE001 - report and go on with the next query
            verdict = f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok  '} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    assert Path("/root/testdata").exists()
    sys.exit(main(sys.argv[1:]))
