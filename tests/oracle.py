"""Run registered queries and their SQL side by side.

    python tests/oracle.py <folder of tables> [name or prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


# Spark type names and the SQL type each must meet.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
}


def differences(df, con, sql: str) -> tuple[list[str], int]:
    """What differs between a DataFrame and a SQL result, and the row count."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} instead of {sorted(names)}")
    for name, kind in df.dtypes:
        if kinds.get(name) != KINDS.get(kind):
            problems.append(f"{name} is {kind}, SQL has {kinds.get(name)}")
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows instead of {len(expected)}")
    elif found != expected:
        wrong = [(f, e) for f, e in zip(found, expected) if f != e]
        problems.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return problems, len(found)


def main() -> int:
    from larkspur.plans import REGISTRY
    from larkspur.session import build_session

    folder, *wanted = sys.argv[1:]
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, entry in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            if entry.oracle is None:
                problems, n = [], entry.run(spark, folder).count()
            else:
                problems, n = differences(entry.run(spark, folder), con, entry.oracle)
        except Exception as error:  # report and go on with the next query
            problems, n = [f"{type(error).__name__}: {str(error)[:600]}"], 0
        bad += bool(problems)
        verdict = "; ".join(problems) or ("ok" if entry.oracle else "ok, no SQL")
        print(f"{name:30} {n:8} rows {time.time() - began:6.1f}s  {verdict}", flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
