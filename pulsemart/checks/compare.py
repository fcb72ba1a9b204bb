"""Comparing a Spark result with the SQL answer: columns, types, rows and values."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [
        tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)
        for row in zip(*columns, strict=True)
    ]
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    ours = result.toArrow()
    theirs = db.sql(sql).to_arrow_table()
    found = []
    types = [
        {f.name: str(f.type).replace("large_", "") for f in table.schema} for table in (ours, theirs)
    ]
    if types[0] != types[1]:
        found.append(f"schema: {types[0]} against {types[1]}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows: {ours.num_rows} against {theirs.num_rows}")
    elif set(types[0]) == set(types[1]):
        wrong = [p for p in zip(_rows(ours), _rows(theirs), strict=True) if p[0] != p[1]]
        if wrong:
            found.append(f"values: {len(wrong)} rows, first {wrong[0]}")
    return found
