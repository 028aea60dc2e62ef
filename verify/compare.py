"""Run every query in Spark and DuckDB and compare rows, columns and types.

    python -m verify.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from provwatch.session import local_session
from verify.registry import expected_sql, spark_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and a statement's result, or None."""
    names = sorted(df.columns)
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    if sorted(expected_names) != names:
        return f"columns {sorted(set(names) ^ set(expected_names))}"
    expected_types = {d[0]: str(d[1]) for d in result.description}
    types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {n: (types[n], expected_types[n]) for n in names if types[n] != expected_types[n]}
    order = [expected_names.index(n) for n in names]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    actual = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if actual != expected:
        extra, missing = list((actual - expected).items())[:1], list((expected - actual).items())[:1]
        columns = []
        if extra and missing:
            columns = [n for n, a, b in zip(names, extra[0][0], missing[0][0]) if a != b]
        return f"rows {actual.total()} vs {expected.total()}; {columns}\n  extra   {extra}\n  missing {missing}"
    return f"types {wrong}" if wrong else None


def main(folder: str, wanted: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql, failures = expected_sql(), 0
    for name, run in spark_queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problem = difference(run(spark, folder), con, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"error {str(error)[:700]}"
        failures += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
