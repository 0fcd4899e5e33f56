"""Compare a Spark result with DuckDB's, column by column, order aside."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(record[i]) for i in order) for record in records),
        key=lambda row: tuple((cell is not None, str(type(cell)), str(cell)) for cell in row),
    )


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences found, none when both sides agree."""
    result = connection.sql(sql)
    names, problems = sorted(result.columns), []
    if sorted(spark_df.columns) != names:
        return [f"columns {sorted(spark_df.columns)} != {names}"]
    duck_types = {n: str(t) for n, t in zip(result.columns, result.types)}
    known = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    }
    for name, kind in spark_df.dtypes:
        if known.get(kind) != duck_types[name]:
            problems.append(f"type of {name}: {kind} vs {duck_types[name]}")
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = _rows(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        problems.append(f"values differ, e.g. {pairs}")
    return problems
