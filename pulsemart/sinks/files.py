"""Writing JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_json(df: DataFrame, path: str) -> None:
    """Add JSON files to a folder; BINARY columns are written as base64."""
    df.write.mode("append").json(path)
