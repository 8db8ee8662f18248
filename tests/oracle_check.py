"""Compares registered queries with their SQL on the given tables: rows, column names, column types, values.

    python tests/oracle_check.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=lambda row: [(v is None, str(v)) for v in row])


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if the query and the SQL agree, else what differs."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    found = _sorted(frame.select(*names).collect())
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} / {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    wrong = {n: (k, types[n]) for n, k in frame.dtypes if KINDS.get(k, k) != types[n]}
    if wrong:
        return f"types {wrong}"
    order = [relation.columns.index(n) for n in names]
    expected = _sorted(tuple(row[i] for i in order) for row in relation.fetchall())
    if len(found) != len(expected):
        return f"rows {len(found)} / {len(expected)}"
    bad = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from vigilog.session import build_session

    sf_dir, *chosen = sys.argv[1:]
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, statements, failed = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        if name in statements:
            try:
                problem = compare(spark, connection, query, statements[name], sf_dir)
            except Exception as error:  # report and go on with the next query
                problem = f"{type(error).__name__}: {str(error)[:1500]}"
        else:
            problem = None if query(spark, sf_dir).count() else "no rows"
        failed += problem is not None
        print(f"{name:28s} {time.time() - began:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
