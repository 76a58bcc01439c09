"""Runs queries beside their SQL and compares the rows.

    python -m workload.check [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from parcelight.session import build_session
from parcelight.storage import ensure_local_folder
from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    if isinstance(value, bool):
        return (1, str(value).lower())
    return (1, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(name: str, df, con) -> str:
    """Empty when the rows of ``df`` equal those of the query's SQL, else what
    differs."""
    mine = df.collect()
    if name not in ORACLE:
        return "" if mine else "no rows"
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    theirs = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expect = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
              "VARCHAR": "string", "BOOLEAN": "boolean"}
    kind_diff = {
        c: (t, kinds[c]) for c, t in df.dtypes
        if expect.get(kinds[c].upper(), kinds[c]) != t
    }
    left, right = rows_of(df.columns, mine), rows_of(names, theirs)
    if left != right:
        odd = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"rows {len(left)} vs {len(right)}; first {odd}"
    return f"types {kind_diff}" if kind_diff else ""


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_local_folder(spark)
    con = connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        begin = time.time()
        try:
            verdict = compare(name, QUERIES[name](spark, sf_dir), con)
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(verdict)
        note = "" if name in ORACLE else " (rows only)"
        print(f"{'FAIL' if verdict else 'ok  '} {name}{note} "
              f"{time.time() - begin:.1f}s {verdict}", flush=True)
    print(f"{bad} of {len(args or QUERIES)} differ")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
