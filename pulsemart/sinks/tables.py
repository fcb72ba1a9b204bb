"""Saving, copying and refreshing tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def save(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Save as a table and return the saved table.

    `mode` is overwrite, append or errorifexists. Reading on from the result, not from
    `df`, stops later steps from repeating the work that made it.
    """
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop(spark: SparkSession, *names: str) -> None:
    """Remove tables that were only a step on the way."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a table, replacing the target."""
    return save(spark.table(source), target)


def refresh(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Recompute a saved dataset and put it in place of the old one.

    `name` is a view of the newest version. The new rows are complete under a name of their own
    before the view is replaced, which is one step in the catalog: readers find the old rows or
    the new ones, a run that fails leaves the old ones, and `build` may read `name`. Nothing is
    renamed or copied; the version before goes last.
    """
    before = _version_behind(spark, name)
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    save(build(), version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    if before is not None:
        drop(spark, before)
    return spark.table(name)


def _version_behind(spark: SparkSession, name: str) -> str | None:
    """The table that the view shows, None if there is no view yet."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    text = next((r["data_type"] for r in rows if r["col_name"] == "View Text"), None)
    if text is None:
        raise ValueError(f"{name} is a table; refresh keeps a view of that name")
    return text.rsplit(" ", 1)[-1]
