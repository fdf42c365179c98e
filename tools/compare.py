"""Run registered queries next to their SQL in DuckDB and report differences.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wayfare.plans.catalog import ORACLES, QUERIES  # noqa: E402
from wayfare.session import build_session  # noqa: E402
from wayfare.travel import TABLES  # noqa: E402


def canonical(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


SPARK_KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
               "boolean": "BOOLEAN"}


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    frame = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    spent = time.time() - started
    if name not in ORACLES:
        return len(got) > 0, f"{len(got)} rows, no SQL, {spent:.1f}s"
    started = time.time()
    result = connection.execute(ORACLES[name])
    sql_columns = [d[0] for d in result.description]
    sql_kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    sql_spent = time.time() - started
    if sorted(frame.columns) != sorted(sql_columns):
        return False, f"columns {sorted(frame.columns)} / {sorted(sql_columns)}"
    kinds = {c: (SPARK_KINDS.get(k, k), sql_kinds[c]) for c, k in frame.dtypes if SPARK_KINDS.get(k, k) != sql_kinds[c]}
    a, b = rows_of(frame.columns, got), rows_of(sql_columns, want)
    if a != b:
        extra, lacking = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return False, (f"{len(a)} rows / {len(b)} rows; only Spark {len(extra)} e.g. {extra[:2]}; "
                       f"only SQL {len(lacking)} e.g. {lacking[:2]}; columns {sorted(frame.columns)}")
    if kinds:
        return False, f"types differ: {kinds}"
    return True, f"{len(a)} rows, {spent:.1f}s (SQL {sql_spent:.2f}s)"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(args.sf)
    failed = 0
    names = args.names or list(QUERIES)
    for name in names:
        try:
            ok, note = compare(spark, connection, name, args.sf)
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
