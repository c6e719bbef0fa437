"""Run every registered query against DuckDB: python tests/compare.py [sf_dir] [names...]."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, run, text: str | None) -> tuple[bool, str, int]:
    frame = run(spark, sf_dir)
    mine = rows_of(frame.columns, frame.collect())
    if text is None:
        return True, "no oracle", len(mine)
    result = connection.execute(text)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return False, f"columns {sorted(frame.columns)} / {sorted(names)}", len(mine)
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:2]
        lacking = [r for r in theirs if r not in set(mine)][:2]
        return False, f"rows {len(mine)} / {len(theirs)}; only here {extra}; only there {lacking}", len(mine)
    return True, "equal", len(mine)


def main() -> int:
    from tallybridge.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, texts, failures = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            good, note, count = compare(spark, connection, sf_dir, run, texts.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            good, note, count = False, "".join(traceback.format_exception_only(error))[:1500], -1
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:26} rows={count:6} {time.time() - started:6.2f}s {'' if good else note}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
