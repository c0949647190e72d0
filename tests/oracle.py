"""Compare a Spark result with DuckDB's, row by row and type by type."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    problems = []
    if sorted(df.columns) != sorted(kinds):
        return [f"columns {sorted(df.columns)} != {sorted(kinds)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    order = sorted(df.columns)
    ours = sorted(tuple(_cell(row[name]) for name in order) for row in df.collect())
    at = [relation.columns.index(name) for name in order]
    theirs = sorted(tuple(_cell(row[i]) for i in at) for row in relation.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {order}: {differing[0]}")
    if not ours:
        problems.append("empty result")
    return problems
