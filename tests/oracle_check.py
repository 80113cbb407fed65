"""Compares every query with its SQL on one scale: python tests/oracle_check.py DIR [name...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from lexitally import session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# What DuckDB calls the types that Spark queries here return.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(rows, order):
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, sf: str, name: str) -> list[str]:
    """Empty when query and SQL agree in columns, types and rows."""
    df = entry.queries()[name](spark, sf)
    result = con.execute(entry.oracle_sql()[name])
    want = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    have = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    if have != want:
        return [f"schema {have} <> {want}"]
    columns, theirs = df.columns, list(want)
    ours = _rows(df.collect(), [columns.index(c) for c in sorted(columns)])
    sql = _rows(rows, [theirs.index(c) for c in sorted(columns)])
    if ours == sql:
        return []
    return [f"{sum(ours.values())} rows <> {sum(sql.values())} rows",
            f"only Spark {list((ours - sql).items())[:3]}", f"only SQL {list((sql - ours).items())[:3]}"]


def main(sf: str, names: list[str]) -> int:
    spark = session.start("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names or entry.oracle_sql():
        started = time.time()
        found = differences(spark, con, sf, name)
        failed += bool(found)
        print(f"{name:22} {'ok' if not found else 'FAILED'} {time.time() - started:.2f}s", *found,
              sep="\n    " if found else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
