"""Compare registered queries with their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import datetime
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.UTC).replace(tzinfo=None)
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """Reasons why a query and its SQL differ; empty when they agree exactly."""
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = _sorted([tuple(_plain(v) for v in r) for r in df.select(*columns).collect()])
    result = con.execute(contract.oracle_sql()[name])
    theirs_columns = [c[0] for c in result.description]
    if sorted(theirs_columns) != columns:
        return [f"columns {columns} <> {sorted(theirs_columns)}"]
    order = [theirs_columns.index(c) for c in columns]
    theirs = _sorted([tuple(r[i] for i in order) for r in result.fetchall()])
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} <> {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b or list(map(type, a)) != list(map(type, b))]
    if bad:
        found.append(f"{len(bad)} rows differ, e.g. {columns}\n   {bad[0][0]}\n   {bad[0][1]}")
    if not ours:
        found.append("empty result")
    return found


def main() -> None:
    from conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name in names or contract.queries():
        start = time.time()
        if name not in contract.oracle_sql():
            print(f"{name}: {contract.queries()[name](spark, sf_dir).count()} rows, no SQL")
            continue
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as exc:
            found = [f"{type(exc).__name__}: {str(exc)[:700]}"]
        failed += bool(found)
        print(f"{name}: {'ok' if not found else ' '.join(found)} ({time.time() - start:.1f} s)", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
