"""Tables written micro-batch by micro-batch, each batch in a directory of its own.

A batch that comes again, after a failure between its rows and the stream's checkpoint, replaces
what it wrote before, so its rows are there once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.sinks.tables import save

BATCH = "batch"


def write_batch(
    rows: DataFrame, table: str, batch: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write the rows of one batch and return them as saved, with the column `batch`.

    Further partition columns come after the batch's number.
    """
    spark, inner = rows.sparkSession, list(partition_by)
    others = [c for c in rows.columns if c not in inner]
    numbered = rows.select(*others, F.lit(batch).cast("long").alias(BATCH), *inner)
    if not spark.catalog.tableExists(table):
        save(numbered.limit(0), table, "append", [BATCH, *inner])
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        numbered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return spark.table(table).where(F.col(BATCH) == batch)
