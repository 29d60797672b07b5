"""Compare a Spark result with the same result from SQL, row by row and value by value."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when both results are the same."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = _rows(expected_columns, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(expected_columns):
        return [f"columns {sorted(df.columns)} <> {sorted(expected_columns)}"]
    problems = []
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows <> {len(expected)} rows")
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            problems.append(f"{a} <> {e}")
            if len(problems) > 3:
                break
    return problems
