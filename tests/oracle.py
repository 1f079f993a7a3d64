"""Run registered queries and compare them with their SQL in DuckDB.

Usage: python tests/oracle.py [table folder] [query name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
          "BOOLEAN": "boolean"}


def _hashable(value):
    return tuple(map(_hashable, value)) if isinstance(value, list) else value


def compare(spark, con, name: str, folder: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = contract.queries()[name](spark, folder)
    got = Counter(tuple(_hashable(row[c]) for c in sorted(df.columns)) for row in df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {df.columns} against {rel.columns}"
    kinds = dict(zip(rel.columns, (_KINDS.get(str(t), str(t)) for t in rel.types)))
    mine = dict(df.dtypes)
    if kinds != mine:
        return f"types {mine} against {kinds}"
    order = [rel.columns.index(c) for c in sorted(rel.columns)]
    want = Counter(tuple(_hashable(row[i]) for i in order) for row in rel.fetchall())
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {str(list(extra)[:2])[:300]}; lacking {str(list(lacking)[:2])[:300]}"
        )
    return None


def main(folder: str, names: list[str]) -> int:
    # A plain session: the queries must not depend on our own settings.
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TIME_ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name in names or contract.queries():
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        kind = "O" if name in contract.oracle_sql() else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} "
              f"{time.perf_counter() - start:.1f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
