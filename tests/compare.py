"""Run registered queries next to their SQL equivalents: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """One spelling per value for both engines, types kept apart."""
    if isinstance(value, (decimal.Decimal, float)):
        return ("real", repr(float(value)))
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{scale}"
    spark = make_session()
    con = connect(sf_dir)
    chosen = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            names, got = spark_rows(entry.queries()[name](spark, sf_dir))
        except Exception as error:  # report and go on with the next query
            print(f"{name:32s} FAILED {str(error)[:400]}", flush=True)
            bad += 1
            continue
        took = time.time() - started
        sql = entry.oracle_sql().get(name)
        if sql is None:
            print(f"{name:32s} rows={len(got)} no oracle {took:.1f}s", flush=True)
            continue
        oracle_names, want = oracle_rows(con, sql)
        same = names == oracle_names and got == want
        bad += not same
        print(f"{name:32s} {'ok' if same else 'DIFFERENT'} rows={len(got)}/{len(want)} {took:.1f}s "
              f"oracle {time.time() - started - took:.1f}s", flush=True)
        if not same:
            print("  columns", names, oracle_names)
            print("  only spark ", sorted(set(got) - set(want))[:3])
            print("  only oracle", sorted(set(want) - set(got))[:3])
    print("different or failed:", bad)


if __name__ == "__main__":
    main()
