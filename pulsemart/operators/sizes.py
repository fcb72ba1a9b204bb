"""Broadcasting a join side only when it is a saved table known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 << 20

# Steps that cannot have more rows than what they read.
NARROWING = {"Project", "Filter", "SubqueryAlias"}


def saved_bytes(df: DataFrame) -> int | None:
    """Bytes of the one saved table that a DataFrame selects from, None if it is anything else.

    A join, a union, an explode or generated rows say nothing about the size of the result, so
    they have none here; save such a side first. The number is that of Spark's file index: no job
    runs, no file names reach the driver, and a table written anew is measured anew.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in NARROWING:
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    return int(plan.stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Ask for a broadcast of a side that is a saved table of at most `most` bytes.

    Files are compressed, so `most` stays well below what executors can hold. For any other
    side the choice is left to Spark, its own threshold and adaptive execution.
    """
    size = saved_bytes(df)
    return F.broadcast(df) if size is not None and size <= most else df
