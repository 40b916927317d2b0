"""Compare a Spark result with a DuckDB result, value by value, in any row order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    cells = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None if equal, else what differs first."""
    result = connection.execute(sql)
    theirs = _sorted_rows([c[0] for c in result.description], result.fetchall())
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows and {len(theirs[1])} rows"
    for mine, other in zip(ours[1], theirs[1]):
        if repr(mine) != repr(other):
            return f"row {mine} and {other}"
    return None
